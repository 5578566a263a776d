"""Merkle manifest of a table: a hash tree over the rows of each group, and one over the groups.

Slot pivot: conditional aggregates spread the children of each parent into `FANOUT` columns. The columns side by side,
hashed, are the parent; the columns without a row's own slot are its siblings.
"""

from __future__ import annotations

from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallybank.llm.common import lasting, table_of_bounded_rows

FANOUT = 16
LEAF_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Bits of a monotonically increasing id that count rows within their partition.
_PLACE_BITS = 33


def framed(value: Column) -> Column:
    """`-` for null, else the number of UTF-8 bytes, a colon and the value, so that no two rows read the same."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts side by side."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def _placed(frame: DataFrame, order: list[str]) -> DataFrame:
    """The frame with `pos`, a row's place in its `grp` by `order`, and `n`, the rows of that group.

    Rows are dealt by ranges of (grp, order), so a group of any size is spread over tasks; only the number of rows of each
    group in each range is added up. `order` must tell all rows apart.
    """
    dealt = frame.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
    dealt = lasting(dealt.withColumn("at", F.monotonically_increasing_id()))
    dealt = dealt.withColumn("range", F.shiftright("at", _PLACE_BITS))
    by_range = Window.partitionBy("grp").orderBy("range")
    parts = dealt.groupBy("grp", "range").agg(F.min("at").alias("first"), F.count("*").alias("here")).select(
        "grp", "range", (F.sum("here").over(by_range) - F.col("here") - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("grp")).alias("n"))
    return dealt.join(table_of_bounded_rows(parts), ["grp", "range"]).withColumn(
        "pos", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _above(n: Column) -> Column:
    return F.ceil(n / F.lit(FANOUT))


def _grow(leaves: DataFrame) -> tuple[list[DataFrame], list[DataFrame]]:
    """(nodes, runs) by level: nodes (grp, pos, n, digest, ...), and (grp, parent, n, slots), the columns of children of the
    nodes one level up, null where there is none. A group ends at the level where it has one node."""
    nodes, runs = [leaves], []
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        parent = F.floor(F.col("pos") / FANOUT).alias("parent")
        pivoted = nodes[-1].where("n > 1").groupBy("grp", parent, _above(F.col("n")).alias("n")).agg(
            *[F.expr(f"max(CASE WHEN pos % {FANOUT} = {i} THEN digest END) AS c{i}") for i in range(FANOUT)])
        runs.append(lasting(pivoted.select("grp", "parent", "n", F.array(*[f"c{i}" for i in range(FANOUT)]).alias("slots"))))
        nodes.append(runs[-1].select("grp", F.col("parent").alias("pos"), "n", digest(F.array_join("slots", "")).alias("digest")))
        most = -(-most // FANOUT)
    return nodes, runs


def _paths(nodes: list[DataFrame], runs: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the lowest level with what `tops` (grp, path, ...) holds of their group and with `path`: from a node
    to the root of its group and on, what stands before and after it at each level."""
    def of_level(level: int) -> DataFrame:
        return tops.join(nodes[level].where("n = 1").select("grp", F.lit(0).cast("long").alias("up")), "grp")

    above = of_level(len(runs))
    for level in reversed(range(len(runs))):
        run = runs[level].drop("n").join(above.withColumnRenamed("up", "parent"), ["grp", "parent"])
        slot = (F.col("pos") % FANOUT).cast("int")
        before, after = (F.array_join(F.slice("slots", at, length), "") for at, length in ((1, slot), (slot + 2, FANOUT - 1 - slot)))
        here = nodes[level].where("n > 1").withColumn("parent", F.floor(F.col("pos") / FANOUT)).join(run, ["grp", "parent"])
        here = here.withColumn("path", F.concat(F.array(F.struct(before.alias("before"), after.alias("after"))), "path")).drop("parent", "slots")
        if level:
            above = here.select(F.col("pos").alias("up"), *tops.columns).unionByName(of_level(level))
        else:
            above = here.unionByName(nodes[0].where("n = 1").join(tops, "grp"))
    return above if runs else nodes[0].join(tops, "grp")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, step: digest(step["before"], node, step["after"]))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings on a path, level by level."""
    return digest(F.array_join(F.transform(path, lambda step: F.concat(step["before"], step["after"])), ""))


def manifest(docs: DataFrame, id_column: str = "doc_id", group_column: str = "source", fields: tuple[str, ...] = LEAF_FIELDS,
             changed: dict[str, Column] | None = None) -> DataFrame:
    """(id, leaf, subroot, root, path, changed_leaf), one row for each row of `docs`.

    A leaf is the digest of the framed `fields`. Leaves of one group (null is a group) ascend by id, null ids first and
    repeated ids by leaf; equal rows have places side by side. Every `FANOUT` nodes of a level become one node of the next,
    until one is left: the subroot. Subroots, ordered by group (null first, then bytewise), give the root in the same way.
    `changed` gives fields with other values; changed_leaf is the leaf with them. An empty table gives an empty result;
    null and empty fields differ. Other columns of `docs` are neither read nor hashed.
    """
    value = {f: F.col(f"`{f}`") for f in fields}
    group = F.col(f"`{group_column}`").cast("string")
    base = lasting(docs.select(
        F.col(f"`{id_column}`").alias("id"), F.coalesce(F.concat(F.lit("+"), group), F.lit("")).alias("grp"),
        digest(*[framed(value[f]) for f in fields]).alias("digest"),
        digest(*[framed((changed or {}).get(f, value[f])) for f in fields]).alias("changed_leaf"),
        F.monotonically_increasing_id().alias("row")))
    leaves = _placed(base, ["id", "digest", "row"]).drop("row")
    nodes, runs = _grow(leaves)
    subroots = reduce(DataFrame.unionByName, [n.where("n = 1").select("grp", "digest") for n in nodes])
    tops = _placed(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), ["name"])
    top_nodes, top_runs = _grow(tops)
    root = next(iter(top_nodes[-1].where("n = 1").select("digest").take(1)), None)
    nothing = F.array().cast("array<struct<before:string,after:string>>")
    whole = docs.sparkSession.range(1).select(F.lit("").alias("grp"), nothing.alias("path"))
    top_paths = _paths(top_nodes, top_runs, whole).select(F.col("name").alias("grp"), F.col("digest").alias("subroot"), "path")
    return _paths(nodes, runs, lasting(top_paths)).select(
        F.col("id").alias(id_column), F.col("digest").alias("leaf"), "subroot",
        F.lit(root["digest"] if root else None).cast("string").alias("root"), "path", "changed_leaf")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, all else as it is."""
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def tamper_check(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, leaf, subroot, root, proof_sha256, folded_root, verified): every row's proof, held against a copy of the table
    in which the rows with crc32(id) divisible by 5 have their A-Z in lower case. Null texts and rows without an id stay."""
    hit = F.crc32(F.col(f"`{id_column}`").cast("string").cast("binary")) % 5 == 0
    text = F.col(f"`{text_column}`")
    proven = manifest(docs, id_column, changed={text_column: F.when(hit, lower_ascii(text)).otherwise(text)})
    proven = proven.withColumn("folded_root", folded(F.col("changed_leaf"), F.col("path")))
    return proven.select(id_column, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                         "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def tamper_sql(table: str = "documents") -> str:
    """The same of a whole table in SQL of DuckDB; crc32 is worked out bit by bit over the digits of the id."""
    fields = " || ".join(f"coalesce(strlen(d.{f}::VARCHAR)::VARCHAR || ':' || d.{f}::VARCHAR, '-')" for f in LEAF_FIELDS[:-1])
    return f"""
WITH RECURSIVE ids AS (
  SELECT DISTINCT doc_id, xor(list_reduce(flatten(list_concat([[4294967295]], list_transform(range(1, length(doc_id::VARCHAR) + 1),
    lambda i: list_concat([ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT], [-1, -1, -1, -1, -1, -1, -1, -1])))),
    lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295) % 5 = 0 AS hit
  FROM {table}
), base AS (
  SELECT d.doc_id, coalesce('+' || source, '') AS grp, {fields} AS head, text,
    CASE WHEN hit THEN translate(text, '{ascii_uppercase}', '{ascii_lowercase}') ELSE text END AS other
  FROM {table} d LEFT JOIN ids ON d.doc_id IS NOT DISTINCT FROM ids.doc_id
), hashed AS (
  SELECT doc_id, grp, sha256(head || coalesce(strlen(text)::VARCHAR || ':' || text, '-')) AS leaf,
    sha256(head || coalesce(strlen(other)::VARCHAR || ':' || other, '-')) AS changed FROM base
), leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY grp) AS n
  FROM hashed
), nodes AS (
  SELECT 0 AS level, grp, pos, n, leaf AS digest FROM leaves
  UNION ALL
  SELECT level + 1, grp, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM nodes WHERE n > 1 GROUP BY level, grp, pos // {FANOUT}, n
), tops AS (
  SELECT 1000 AS level, row_number() OVER (ORDER BY grp) - 1 AS pos, count(*) OVER () AS n, digest, grp FROM nodes WHERE n = 1
), top_nodes AS (
  SELECT level, pos, n, digest FROM tops
  UNION ALL
  SELECT level + 1, pos // {FANOUT}, (n + {FANOUT - 1}) // {FANOUT}, sha256(string_agg(digest, '' ORDER BY pos))
  FROM top_nodes WHERE n > 1 GROUP BY level, pos // {FANOUT}, n
), steps AS (
  SELECT grp, level, pos // {FANOUT} AS run, list(digest ORDER BY pos) AS kids FROM nodes WHERE n > 1 GROUP BY ALL
  UNION ALL
  SELECT NULL, level, pos // {FANOUT}, list(digest ORDER BY pos) FROM top_nodes WHERE n > 1 GROUP BY ALL
), walk AS (
  SELECT doc_id, grp, leaf, 0 AS level, pos, n, changed AS node, '' AS proof FROM leaves
  UNION ALL
  SELECT w.doc_id, w.grp, w.leaf, CASE WHEN w.n > 1 THEN w.level + 1 ELSE 1000 END,
    CASE WHEN w.n > 1 THEN w.pos // {FANOUT} ELSE t.pos END, CASE WHEN w.n > 1 THEN (w.n + {FANOUT - 1}) // {FANOUT} ELSE t.n END,
    CASE WHEN w.n > 1 THEN sha256(array_to_string(list_transform(s.kids, lambda k, i: CASE WHEN i = w.pos % {FANOUT} + 1 THEN w.node ELSE k END), ''))
      ELSE w.node END,
    CASE WHEN w.n > 1 THEN w.proof || array_to_string(list_concat(s.kids[1:w.pos % {FANOUT}], s.kids[w.pos % {FANOUT} + 2:]), '')
      ELSE w.proof END
  FROM walk w JOIN tops t ON t.grp = w.grp
  LEFT JOIN steps s ON s.level = w.level AND s.run = w.pos // {FANOUT} AND (s.grp = w.grp OR w.level >= 1000 AND s.grp IS NULL)
  WHERE w.n > 1 OR w.level < 1000
)
SELECT w.doc_id, w.leaf, t.digest AS subroot, r.digest AS root, sha256(w.proof) AS proof_sha256, w.node AS folded_root,
  w.node = r.digest AS verified
FROM walk w JOIN tops t ON t.grp = w.grp, (SELECT digest FROM top_nodes WHERE n = 1) r
WHERE w.level >= 1000 AND w.n = 1"""
