import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from legajo.llm import pack


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=200))
def test_assignment_holds_the_capacity(sizes):
    out = pack.assign(np.array(sizes, dtype=np.int64), 100)
    assert len(out) == len(sizes)
    load = {}
    for c, n in zip(out.tolist(), sizes):
        load[c] = load.get(c, 0) + n
    assert all(v <= 100 for v in load.values())
    assert len(load) <= max(1, 2 * sum(sizes) / 100 + 1)


def test_cheapest_container_with_room_is_chosen():
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 60, 300)
    got = pack.assign(sizes, 100)
    # The same by looking at every container.
    n = -(-int(sizes.sum()) // 100)
    room, cost, want = [100] * n, [0.0] * n, np.zeros(len(sizes), int)
    for k in np.argsort(-sizes, kind="stable"):
        fits = [(cost[c], c) for c in range(len(room)) if room[c] >= sizes[k]]
        if fits:
            least = min(fits)[0]
            c = int(got[k]) if int(got[k]) < len(room) and room[got[k]] >= sizes[k] and cost[got[k]] == least else min(fits)[1]
        else:
            room.append(100)
            cost.append(0.0)
            c = len(room) - 1
        want[k] = c
        room[c] -= sizes[k]
        cost[c] += pack.LINEAR * sizes[k] + pack.QUADRATIC * float(sizes[k]) ** 2
    assert (got == want).all()


def test_parts_are_whole_and_cut_between_characters(spark):
    texts = [(1, "ñ" * 5000), (2, "x" * 4095), (3, "y" * 4096), (4, ""), (5, None), (6, "\U0001f4ce" * 3000), (7, "é€x" * 2500), (7, "again")]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    by = {}
    for r in pack.parts(df).collect():
        by.setdefault(r.doc_id, []).append(r)
    assert 5 not in by
    for i, text in texts[:7]:
        if text is None:
            continue
        raw = text.encode()
        rows = sorted((r for r in by[i] if r.end_byte <= len(raw) and (i != 7 or len(by[i]) > 1)), key=lambda r: (r.part_no, r.end_byte))
        rows = [r for r in rows if not (i == 7 and r.part_no == 0 and r.end_byte == 5)]
        assert b"".join(raw[r.start_byte : r.end_byte] for r in rows) == raw
        assert all(r.tokens == r.end_byte - r.start_byte + 1 <= 4096 for r in rows)
        for r in rows:
            raw[r.start_byte : r.end_byte].decode()
        assert (len(rows) > 1) == (len(raw) + 1 > 4096)


def test_pack(spark):
    texts = [(k, "a" * (137 * k % 5000)) for k in range(200)]
    df = spark.createDataFrame(texts, "doc_id bigint, text string")
    out = pack.pack(df, shard_rows=60)
    rows = out.collect()
    load = {}
    for r in rows:
        load[r.container_id] = load.get(r.container_id, 0) + r.tokens
    assert max(load.values()) <= 4096
    assert {r.doc_id for r in rows} == set(range(200))
    assert sorted(r.doc_id for r in pack.oversized(out).collect()) == [k for k, t in texts if len(t) + 1 > 4096]
    assert sorted(map(tuple, rows)) == sorted(map(tuple, pack.pack(df.repartition(7), shard_rows=60).collect()))
    assert pack.pack(df.limit(0)).count() == 0


def test_shards_count_pieces(spark):
    df = spark.createDataFrame([(1, "x" * 400_000), (2, "y")], "doc_id bigint, text string")
    out = pack.pack(df, shard_rows=20)
    per = out.selectExpr("container_id >> 32 as shard").groupBy("shard").count().collect()
    assert 3 <= len(per) <= 6 and max(r["count"] for r in per) < 40
    assert out.filter("doc_id = 1").agg({"end_byte": "max"}).first()[0] == 400_000
