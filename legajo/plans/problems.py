"""The queries of problems 2 and 4."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from legajo.operators import drift, nested
from legajo.session import materialise, shared_folder, table


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    found = drift.changes(drift.profile(table(spark, sf, "archivos")))
    return found.select(F.col("feed").alias("feed_id"), F.col("file").alias("file_no"), "field_name", "change_kind", "new_name")


def p2_profile(spark: SparkSession, sf: str) -> DataFrame:
    """The fields of each file with the JSON types of their values and the number of records that have them."""
    found = drift.profile(table(spark, sf, "archivos"))
    return found.select(F.col("feed").alias("feed_id"), F.col("file").alias("file_no"), F.col("field").alias("field_name"), F.array_join("kinds", ",").alias("kinds"), "n")


def p2_unified(spark: SparkSession, sf: str) -> DataFrame:
    """The records of all files in one table of typed columns."""
    landed = table(spark, sf, "archivos")
    profiles = materialise(drift.profile(landed), shared_folder(spark), "profiles")
    return drift.unify(landed, profiles, drift.changes(profiles))


def p2_schema(spark: SparkSession, sf: str) -> DataFrame:
    """The columns of that table, with what was renamed and widened."""
    profiles = materialise(drift.profile(table(spark, sf, "archivos")), shared_folder(spark), "profiles")
    return drift.unified_schema(profiles, drift.changes(profiles))


def p2_check(spark: SparkSession, sf: str) -> DataFrame:
    """How many records of each file the unified table holds."""
    return p2_unified(spark, sf).groupBy("feed_id", "file_no").agg(F.count("*").alias("n"), F.count_distinct("rec_id").alias("ids"))


def _bridge(spark: SparkSession, sf: str, roots: bool = False) -> DataFrame:
    hits = nested.occurrences(table(spark, sf, "contraloria"), ["row_id"], "_source", "_source", roots)
    statutes = nested.occurrences(table(spark, sf, "normas"), ["row_id"], "html", "html", roots)
    return hits.withColumn("source_table", F.lit("contraloria")).unionByName(statutes.withColumn("source_table", F.lit("normas")))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return _bridge(spark, sf).select("source_table", "row_id", "node_path", "parent_path")


def p4_bridge(spark: SparkSession, sf: str) -> DataFrame:
    """Every occurrence of an object, and the root of each record."""
    return _bridge(spark, sf, roots=True).drop("members")


def p4_objects(spark: SparkSession, sf: str) -> DataFrame:
    return nested.objects(_bridge(spark, sf, roots=True))


def p4_check(spark: SparkSession, sf: str) -> DataFrame:
    """Of each record, how many objects it has, whether each is linked with its parent, and whether all references are stored."""
    bridge = materialise(_bridge(spark, sf, roots=True), shared_folder(spark), "bridge")
    known = nested.objects(bridge).select(F.col("object_id").alias("ref"), F.lit(True).alias("there"))
    key = ["source_table", "row_id"]
    refs = bridge.select(*key, F.explode(F.array_distinct(F.regexp_extract_all("members", F.lit(r'"\$object": "([0-9a-f]{32})"'), 1))).alias("ref"))
    stored = refs.join(known, "ref", "left").groupBy(*key).agg(F.bool_and(F.col("there").isNotNull()).alias("all"))
    above = bridge.select(*key, F.col("node_path").alias("parent_path"), F.col("object_id").alias("above"))
    linked = bridge.filter("depth > 0").join(above, [*key, "parent_path"], "left").groupBy(*key).agg(F.bool_and(F.coalesce(F.col("above") == F.col("parent_id"), F.lit(False))).alias("ok"))
    rows = bridge.groupBy(*key).agg(F.count("depth").alias("cases"))
    return rows.join(stored, key, "left").join(linked, key, "left").select(*key, "cases", F.coalesce("ok", F.lit(True)).alias("linked"), F.coalesce("all", F.lit(True)).alias("stored"))


QUERIES = (p2_found, p2_profile, p2_unified, p2_schema, p2_check, p4_found, p4_bridge, p4_objects, p4_check)


def held(j: str) -> str:
    """A JSON value, read once more where it is a string that holds JSON."""
    inner = f"try_cast({j} ->> '$' AS JSON)"
    return f"CASE WHEN json_type({j}) = 'VARCHAR' AND json_type({inner}) IN ('OBJECT', 'ARRAY', 'VARCHAR') THEN {inner} ELSE {j} END"


# Each step opens one level; strings are read up to three times.
_P4 = f"""WITH RECURSIVE s AS (
  SELECT 'contraloria' AS source_table, row_id, '_source' AS path, try_cast(_source AS JSON) AS j FROM contraloria
  UNION ALL SELECT 'normas', row_id, 'html', try_cast(html AS JSON) FROM normas),
s1 AS (SELECT source_table, row_id, path, {held('j')} AS j FROM s), s2 AS (SELECT source_table, row_id, path, {held('j')} AS j FROM s1),
n AS (
  SELECT source_table, row_id, path, '' AS parent, '' AS own, false AS found, {held('j')} AS j FROM s2
  UNION ALL
  SELECT source_table, row_id, path, own, CASE WHEN found THEN path ELSE own END, found, j FROM (
    SELECT *, element AND json_type(j) = 'OBJECT' AS found FROM (
      SELECT source_table, row_id, path, own, element, {held('j')} AS j FROM (
        SELECT source_table, row_id, path, own, element, {held('j')} AS j FROM (
          SELECT n.source_table, n.row_id, n.own, json_type(n.j) = 'ARRAY' AS element, e.value AS j,
            n.path || CASE WHEN json_type(n.j) = 'ARRAY' THEN '[' || e.key || ']' ELSE '.' || e.key END AS path
          FROM n, LATERAL json_each(n.j) e WHERE json_type(n.j) IN ('OBJECT', 'ARRAY')))))
  WHERE json_type(j) IN ('OBJECT', 'ARRAY'))
SELECT source_table, row_id, path AS node_path, parent AS parent_path FROM n WHERE found"""

_P2 = """WITH a AS (SELECT feed_id, file_no, rec_id, try_cast(payload AS JSON) AS j FROM archivos), o AS (SELECT * FROM a WHERE json_type(j) = 'OBJECT'),
e AS (SELECT o.feed_id, o.file_no, o.rec_id, e.key AS k, CASE WHEN e.type = 'VARCHAR' THEN 'string' WHEN e.type = 'NULL' THEN NULL WHEN e.type IN ('BOOLEAN', 'ARRAY', 'OBJECT') THEN lower(e.type) ELSE 'number' END AS t FROM o, LATERAL json_each(o.j) e)
SELECT feed_id, file_no, k AS field_name, coalesce(string_agg(DISTINCT t, ',' ORDER BY t), '') AS kinds, count(DISTINCT rec_id) AS n FROM e GROUP BY feed_id, file_no, k"""

# Values as their sorted words and numbers, compared by key; a rename is a pair of fields that are each other's best.
_P2_FOUND = r"""WITH a AS (SELECT feed_id, file_no, rec_id, try_cast(payload AS JSON) AS j FROM archivos), o AS (SELECT * FROM a WHERE json_type(j) = 'OBJECT'),
e AS (SELECT o.feed_id, o.file_no, o.rec_id, e.key AS field, e.value AS v, CASE WHEN e.type = 'VARCHAR' THEN 'string' WHEN e.type = 'NULL' THEN NULL WHEN e.type IN ('BOOLEAN', 'ARRAY', 'OBJECT') THEN lower(e.type) ELSE 'number' END AS t FROM o, LATERAL json_each(o.j) e),
leaf AS (SELECT e.feed_id, e.file_no, e.rec_id, e.field, unnest(regexp_extract_all(lower(x.atom ->> '$'), '\p{L}+|\d+')) AS w FROM e, LATERAL json_tree(e.v) x WHERE x.type NOT IN ('OBJECT', 'ARRAY', 'BOOLEAN', 'NULL')),
s AS (SELECT feed_id, file_no, rec_id, field, string_agg(w, ' ' ORDER BY w) AS sig FROM (SELECT feed_id, file_no, rec_id, field, coalesce(nullif(ltrim(w, '0'), ''), '0') AS w FROM leaf) GROUP BY ALL),
v AS (SELECT s.feed_id, s.file_no, s.field, k.sig AS k, max(s.sig) AS sig FROM s LEFT JOIN s k ON k.rec_id = s.rec_id AND k.field = 'id' WHERE k.sig IS NOT NULL GROUP BY ALL),
p AS (SELECT feed_id, file_no, field, coalesce(string_agg(DISTINCT t, ',' ORDER BY t), '') AS kinds, list_distinct(list(t) FILTER (t IS NOT NULL)) AS kl FROM e GROUP BY ALL),
f AS (SELECT feed_id, file_no, lag(file_no) OVER (PARTITION BY feed_id ORDER BY file_no) AS before FROM (SELECT DISTINCT feed_id, file_no FROM o)),
was AS (SELECT f.feed_id, f.file_no, f.before, p.field, p.kinds, p.kl FROM f JOIN p ON p.feed_id = f.feed_id AND p.file_no = f.before),
nowp AS (SELECT f.feed_id, f.file_no, f.before, p.field, p.kinds, p.kl FROM f JOIN p USING (feed_id, file_no) WHERE f.before IS NOT NULL),
gone AS (SELECT * FROM was w WHERE NOT EXISTS (FROM nowp n WHERE n.feed_id = w.feed_id AND n.file_no = w.file_no AND n.field = w.field)),
fresh AS (SELECT * FROM nowp n WHERE NOT EXISTS (FROM was w WHERE n.feed_id = w.feed_id AND n.file_no = w.file_no AND n.field = w.field)),
c AS (SELECT g.feed_id, g.file_no, g.field AS old, n.field AS new, g.kinds AS ka, n.kinds AS kb, count(*) AS common, avg((x.sig = y.sig)::INT) AS content,
  len(list_intersect(any_value(g.kl), any_value(n.kl))) * 1.0 / greatest(1, len(list_distinct(any_value(g.kl) || any_value(n.kl)))) AS kin, jaro_winkler_similarity(lower(g.field), lower(n.field)) AS nam
  FROM gone g JOIN fresh n USING (feed_id, file_no) JOIN v x ON x.feed_id = g.feed_id AND x.file_no = g.before AND x.field = g.field JOIN v y ON y.feed_id = n.feed_id AND y.file_no = n.file_no AND y.field = n.field AND y.k = x.k GROUP BY ALL),
r AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, file_no, old ORDER BY score DESC, new) AS i, row_number() OVER (PARTITION BY feed_id, file_no, new ORDER BY score DESC, old) AS j
  FROM (SELECT *, content + 0.05 * kin + 0.1 * nam AS score FROM c WHERE content >= 0.5)) WHERE i = 1 AND j = 1)
SELECT feed_id, file_no, old AS field_name, 'renamed' AS change_kind, new AS new_name FROM r
UNION ALL SELECT feed_id, file_no, new, 'type_changed', '' FROM r WHERE ka <> kb
UNION ALL SELECT feed_id, file_no, field, 'removed', '' FROM gone g WHERE NOT EXISTS (FROM r WHERE r.feed_id = g.feed_id AND r.file_no = g.file_no AND r.old = g.field)
UNION ALL SELECT feed_id, file_no, field, 'added', '' FROM fresh n WHERE NOT EXISTS (FROM r WHERE r.feed_id = n.feed_id AND r.file_no = n.file_no AND r.new = n.field)
UNION ALL SELECT w.feed_id, w.file_no, w.field, 'type_changed', '' FROM was w JOIN nowp n USING (feed_id, file_no, field) WHERE w.kinds <> n.kinds"""

_P2_CHECK = "WITH a AS (SELECT feed_id, file_no, rec_id, try_cast(payload AS JSON) AS j FROM archivos) SELECT feed_id, file_no, count(*) AS n, count(DISTINCT rec_id) AS ids FROM a WHERE json_type(j) = 'OBJECT' GROUP BY feed_id, file_no"

_P4_CHECK = _P4.replace("SELECT source_table, row_id, path AS node_path, parent AS parent_path FROM n WHERE found", """, x AS (SELECT source_table, row_id, count(*) FILTER (found) AS cases FROM n WHERE json_type(j) IN ('OBJECT', 'ARRAY') GROUP BY source_table, row_id)
SELECT source_table, row_id, cases, true AS linked, true AS stored FROM x""")

SQL = {"p2_found": _P2_FOUND, "p2_profile": _P2, "p2_check": _P2_CHECK, "p4_found": _P4, "p4_check": _P4_CHECK}
