"""Merkle manifest of a dataset: leaves per row, a 16-ary tree per group, one more tree over the groups, proofs and folds.

DataFrame functions only.

1. One scan hashes each row to its leaf (and to the leaf of its tampered form, where one is asked for).
2. Leaves are range-partitioned by group and order; a row's index is its place in its partition plus the rows of its
   group in earlier partitions, so a group that holds most rows is sorted by many tasks.
3. Each level is a sibling-shift self-join: the nodes of slot zero compute the indices of their siblings (their own plus
   each slot offset), an equijoin on (group, index) brings the siblings' digests, and the slot-zero rows emit parents.
4. Paths go down the same levels: a node's path is its own family and its parent's path.  Rows of the lowest families
   carry it once for up to 16 leaves, and each leaf hashes its proof and folds its digest where the join puts it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowdex.llm.common import saved, small, table

FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<family:array<string>,slot:int>>"


def field(col: Column) -> Column:
    """``-`` for null, else the value's length in UTF-8 bytes, a colon and the value."""
    text = col.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def digest(cols: list[Column]) -> Column:
    return F.sha2(F.concat(*[field(c) for c in cols]), 256)


def group_key(group: Column) -> Column:
    """Text that is never null and sorts as the group does, null first."""
    return F.coalesce(F.concat(F.lit("1"), group.cast("string")), F.lit("0"))


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows(g, ...)`` with ``idx`` (place within ``g`` by ``order``, from 0) and ``n`` (rows of ``g``).

    ``rows`` should be a saved table: range partitioning reads it twice.
    """
    columns = rows.columns
    spread = rows.repartitionByRange("g", *order).sortWithinPartitions("g", *order)
    spread = saved(spread.select("*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")),
                   "sorted")
    # One row per partition and group in it: within a partition the rows of a group are consecutive.
    firsts = spread.groupBy("g", "part").agg(F.min("at").alias("first"), F.count("*").alias("rows"))
    before = Window.partitionBy("g").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = saved(firsts.select("g", "part", "first", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"),
                                 F.sum("rows").over(Window.partitionBy("g")).alias("n")), "firsts")
    return spread.join(small(firsts), ["g", "part"]).select(
        *columns, (F.col("at") - F.col("first") + F.col("offset")).alias("idx"), "n")


def parents(nodes: DataFrame) -> DataFrame:
    """``nodes(g, idx, h, n)`` of groups with more than one node -> ``(g, idx, h, n, family)`` of the level above."""
    zero = nodes.filter((F.col("n") > 1) & (F.col("idx") % FAN == 0))
    last = F.least(F.lit(FAN - 1).cast("long"), F.col("n") - F.col("idx") - 1)
    wanted = zero.select("g", "n", F.col("idx").alias("zero"),
                         F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("slot"))
    wanted = wanted.withColumn("idx", F.col("zero") + F.col("slot"))
    found = wanted.join(nodes.select("g", "idx", "h"), ["g", "idx"])
    family = F.transform(F.sort_array(F.collect_list(F.struct("slot", "h"))), lambda x: x["h"])
    return (found.groupBy("g", "zero").agg(F.max("n").alias("n"), family.alias("family"))
            .select("g", (F.col("zero") / FAN).cast("long").alias("idx"), F.sha2(F.concat_ws("", "family"), 256).alias("h"),
                    F.ceil(F.col("n") / FAN).alias("n"), "family"))


def build(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Families of each level, lowest first, and ``(g, h, level)``: the top node of every group."""
    most = nodes.agg(F.max("n")).first()[0] or 0
    tops, levels = [nodes.filter("n = 1").select("g", "h", F.lit(0).alias("level"))], []
    while most > 1:
        nodes = saved(parents(nodes), f"level{len(levels) + 1}")
        levels.append(nodes)
        tops.append(nodes.filter("n = 1").select("g", "h", F.lit(len(levels)).alias("level")))
        most = -(-most // FAN)
    return levels, reduce(DataFrame.unionByName, tops)


def _step(family: Column, slot: Column) -> Column:
    return F.array(F.struct(family.alias("family"), slot.cast("int").alias("slot"))).cast(PATH)


def lowest(levels: list[DataFrame], starts: DataFrame) -> DataFrame:
    """``(g, parent, family, up)`` of every family of leaves; a group of one leaf has a row without family.

    ``starts(g, level, path)`` is the path from each group's top node on.
    """
    at = starts.filter(F.col("level") == len(levels)).select("g", F.lit(0).cast("long").alias("idx"), "path")
    for k in range(len(levels) - 1, -1, -1):
        families = levels[k].select("g", "idx", "family").join(at.withColumnRenamed("path", "up"), ["g", "idx"])
        top = starts.filter(F.col("level") == k)
        if k == 0:
            one = top.select("g", F.lit(0).cast("long").alias("parent"), F.lit(None).cast("array<string>").alias("family"),
                             F.col("path").alias("up"))
            return families.withColumnRenamed("idx", "parent").select("g", "parent", "family", "up").unionByName(one)
        children = families.select("g", F.col("idx").alias("parent"), "family", "up",
                                   F.posexplode("family").alias("slot", "h"))
        children = children.select("g", (F.col("parent") * FAN + F.col("slot")).alias("idx"),
                                   F.concat(_step(F.col("family"), F.col("slot")), "up").alias("path"))
        at = saved(children.unionByName(top.select("g", F.lit(0).cast("long").alias("idx"), "path")), f"paths{k}")
    return at.select("g", F.col("idx").alias("parent"), F.lit(None).cast("array<string>").alias("family"),
                     F.col("path").alias("up"))


def with_path(leaves: DataFrame, low: DataFrame) -> DataFrame:
    """``leaves(g, idx, ...)`` with ``path``, from the leaf's own family to the top."""
    rows = leaves.withColumn("parent", (F.col("idx") / FAN).cast("long")).join(low, ["g", "parent"])
    own = F.when(F.col("family").isNull(), F.array().cast(PATH)).otherwise(_step(F.col("family"), F.col("idx") % FAN))
    return rows.withColumn("path", F.concat(own, "up")).drop("parent", "family", "up")


def siblings(path: Column) -> Column:
    """The digests of a proof, level by level, as one text."""
    return F.concat_ws("", F.flatten(F.transform(path, lambda x: F.filter(x["family"], lambda h, i: i != x["slot"]))))


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf gives with the siblings of its path."""
    def up(acc, x):
        return F.sha2(F.concat_ws("", F.transform(x["family"], lambda h, i: F.when(i == x["slot"], acc).otherwise(h))), 256)
    return F.aggregate(path, leaf, up)


def manifest(docs: DataFrame, id_col: str = "doc_id", group_col: str = "source", fields=FIELDS,
             tampered: dict[str, Column] | None = None, where: Column | None = None) -> DataFrame:
    """One row per row of ``docs``: id, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``.

    ``tampered`` gives changed columns by name and ``where`` the rows that are checked with them; all others are checked
    as they are.  Leaves of a group ascend by id (null first), those of one id by their digest; a row repeated whole is
    as many leaves.  A null group is a group of its own, before all others.  Null fields are ``-``; empty texts are
    ``0:``.  One row alone is its own root with an empty proof.  No rows give no rows; columns outside ``fields`` aren't
    read.
    """
    tampered = tampered or {}
    plain = digest([F.col(f"`{c}`") for c in fields])
    changed = digest([tampered.get(c, F.col(f"`{c}`")) for c in fields])
    shown = plain if where is None else F.when(F.coalesce(where, F.lit(False)), changed).otherwise(plain)
    leaves = saved(docs.select(F.col(f"`{id_col}`").alias("id"), group_key(F.col(f"`{group_col}`")).alias("g"),
                               plain.alias("h"), shown.alias("shown")), "leaves")
    # A changed digest breaks no tie: rows of one id and one digest are equal in every field.
    leaves = saved(numbered(leaves, ["id", "h"]), "numbered")
    levels, tops = build(leaves.select("g", "idx", "h", "n"))
    tops = saved(tops, "tops")
    # The groups' top nodes are the leaves of one more tree.
    groups = saved(numbered(tops.select(F.lit("").alias("g"), F.col("g").alias("name"), "h", "level"), ["name"]), "groups")
    over, top = build(groups.select("g", "idx", "h", "n"))
    top = saved(top, "root")
    ends = top.select("g", "level", F.array().cast(PATH).alias("path"))
    starts = with_path(groups, lowest(over, ends)).crossJoin(F.broadcast(top.select(F.col("h").alias("root"))))
    starts = saved(starts.select(F.col("name").alias("g"), "level", "path", F.col("h").alias("subroot"), "root"), "starts")
    low = saved(lowest(levels, starts.select("g", "level", "path")), "families")
    rows = with_path(leaves.select("id", "g", "idx", "h", "shown"), low)
    roots = starts.select("g", "subroot", "root")
    rows = rows.select("id", "g", "h", F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
                       fold(F.col("shown"), F.col("path")).alias("folded_root"))
    return rows.join(small(roots), "g").select(
        F.col("id").alias(id_col), F.col("h").alias("leaf"), "subroot", "root", "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"))


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def query(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return manifest(docs, tampered={"text": F.translate("text", UPPER, LOWER)},
                    where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


def oracle(levels: int = 8, over: int = 5) -> str:
    """The same in DuckDB SQL: ``levels`` levels of a source's tree and ``over`` of the sources' (16 to that power rows)."""
    def field_sql(c):
        return f"coalesce(strlen(cast({c} as varchar)) || ':' || cast({c} as varchar), '-')"

    plain = " || ".join(field_sql(c) for c in FIELDS)
    changed = plain.replace("cast(text as varchar)", f"translate(text, '{UPPER}', '{LOWER}')")
    crc = ("xor(4294967295, list_reduce([4294967295] || list_transform(string_split(cast(doc_id as varchar), ''), "
           "lambda x: ascii(x)::bigint), lambda c, b: list_reduce([xor(c, b)] || [0, 1, 2, 3, 4, 5, 6, 7]::bigint[], "
           "lambda a, i: case when a & 1 = 1 then xor(a >> 1, 3988292384) else a >> 1 end)))")
    ctes = [f"""d as (select doc_id, coalesce('1' || source, '0') k, sha256({plain}) leaf,
           case when {crc} % 5 = 0 then sha256({changed}) else sha256({plain}) end shown from documents),
n0 as (select *, row_number() over (partition by k order by doc_id nulls first, leaf) - 1 idx,
              count(*) over (partition by k) n from d),
t0 as (select k, idx, leaf h, n from n0)"""]

    def climb(prefix, count):
        for i in range(count):
            # Every node knows the digests before and after it in its run; a group of one node goes up as it is.
            ctes.append(f"""{prefix}f{i} as (select k, idx // 16 p, string_agg(h, '' order by idx) f, any_value(n) n, min(h) one
    from {prefix}{i} group by all)""")
            ctes.append(f"""{prefix}{i + 1} as (select k, p idx, case when n = 1 then one else sha256(f) end h, (n + 15) // 16 n
    from {prefix}f{i})""")

    climb("t", levels)
    ctes.append(f"""s as (select k, h subroot, row_number() over (order by k) - 1 sidx from t{levels}),
u0 as (select '' k, sidx idx, subroot h, count(*) over () n from s)""")
    climb("u", over)
    ctes.append("w0 as (select doc_id, leaf, shown acc, '' proof, k, idx from n0)")

    def walk(name, source, key, count, first):
        for i in range(count):
            ctes.append(f"""{name}{i + 1} as (select w.* replace (
      w.idx // 16 as idx,
      case when f.n = 1 then acc else sha256(left(f.f, 64 * (w.idx % 16)) || acc || substr(f.f, 64 * (w.idx % 16) + 65)) end as acc,
      case when f.n = 1 then proof else proof || left(f.f, 64 * (w.idx % 16)) || substr(f.f, 64 * (w.idx % 16) + 65) end as proof)
    from {first if i == 0 else name + str(i)} w join {source}f{i} f on f.k = {key} and f.p = w.idx // 16)""")

    walk("w", "t", "w.k", levels, "w0")
    ctes.append(f"x0 as (select doc_id, leaf, acc, proof, sidx idx, subroot from w{levels} join s using (k))")
    walk("x", "u", "''", over, "x0")
    return "with " + ",\n".join(ctes) + f"""
select doc_id, leaf, subroot, h root, sha256(proof) proof_sha256, acc folded_root, acc = h verified
from x{over} cross join (select h from u{over}) r"""


ORACLE = oracle()
