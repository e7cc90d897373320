"""Result pages for tests: a large base of 60,000 rulings of which one page fails, and a small one."""

import json


def page(base: str, offset: int) -> str | None:
    if base == "big" and offset == 1000:
        raise TimeoutError("page 1000")
    total = 60_000 if base == "big" else 520
    return json.dumps({"response": {"docs": [{"id": k} for k in range(offset, min(total, offset + 50))]}})
