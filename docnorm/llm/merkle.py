"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections (DataFrame functions only).

A text is cut into sections (at empty lines), these into paragraphs (lines), these into
leaves (up to a full stop, 32 characters at most). Every level's hash is the hash of the
hashes below it, so equal roots mean equal texts, and going down where hashes differ finds
the edited branch. The fingerprint string carries the root and the leaf hashes.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from docnorm.llm.common import table, write_table

LEAF = r"[^.\n]{1,32}[.]*|[.]+"
LEAF_HEX = 8
BUCKET_ROWS, MOST_BUCKETS = 2000, 4096


def tree(text: Column) -> Column:
    """sections: array<struct<hash, paragraphs: array<struct<hash, leaves: array<string>>>>>."""
    def paragraph(line):
        leaves = F.transform(F.regexp_extract_all(line, F.lit(LEAF), F.lit(0)), lambda x: F.left(F.md5(x), F.lit(LEAF_HEX)))
        return F.struct(F.md5(line).alias("hash"), leaves.alias("leaves"))

    def section(part):
        return F.transform(F.split(part, "\n"), paragraph)

    nested = F.transform(F.split(text, "\n\n"), section)
    return F.transform(nested, lambda lines: F.struct(
        F.md5(F.array_join(F.transform(lines, lambda p: p["hash"]), "")).alias("hash"), lines.alias("paragraphs")))


def root(sections: Column) -> Column:
    return F.md5(F.array_join(F.transform(sections, lambda s: s["hash"]), ""))


def leaves(sections: Column) -> Column:
    return F.flatten(F.transform(sections, lambda s: F.flatten(F.transform(s["paragraphs"], lambda p: p["leaves"]))))


def fingerprint(sections: Column) -> Column:
    """``<root>:<leaf hashes, in order>``."""
    return F.concat(root(sections), F.lit(":"), F.array_join(leaves(sections), ""))


def leaves_of(print_: Column) -> Column:
    """Distinct leaf hashes read from a fingerprint string."""
    return F.array_distinct(F.regexp_extract_all(F.substr(print_, F.lit(34)), F.lit(f".{{{LEAF_HEX}}}"), F.lit(0)))


def likeness(a: Column, b: Column, set_a: Column, set_b: Column) -> Column:
    """Of two fingerprints and their leaf sets: 1 for equal roots, else the leaves in common
    as a share of both sets' leaves."""
    both, of = F.size(F.array_intersect(set_a, set_b)), F.size(set_a) + F.size(set_b)
    return F.when(F.left(a, F.lit(32)) == F.left(b, F.lit(32)), F.lit(1.0)).otherwise(
        F.when(of > 0, both * 2 / of).otherwise(F.lit(0.0)))


def edited_branches(a: Column, b: Column) -> Column:
    """(section, paragraph) places, from 0, where two trees differ; equal sections are not entered."""
    def inside(i):
        left, right = F.get(a, i)["paragraphs"], F.get(b, i)["paragraphs"]
        places = F.sequence(F.lit(0), F.greatest(F.size(F.coalesce(left, F.array())), F.size(F.coalesce(right, F.array())), F.lit(1)) - 1)
        return F.transform(F.filter(places, lambda j: ~F.get(left, j)["hash"].eqNullSafe(F.get(right, j)["hash"])),
                           lambda j: F.struct(i.alias("section"), j.alias("paragraph")))

    every = F.sequence(F.lit(0), F.greatest(F.size(a), F.size(b)) - 1)
    differ = F.filter(every, lambda i: ~F.get(a, i)["hash"].eqNullSafe(F.get(b, i)["hash"]))
    return F.flatten(F.transform(differ, inside))


def bucket_of(value: Column, bounds: list[int]) -> Column:
    """Number of ascending ``bounds`` at or below ``value`` (null: after the last), found in
    two steps: first among every 64th bound, then among the 64 behind it."""
    coarse = bounds[::64]
    block = F.size(F.filter(F.array(*[F.lit(b) for b in coarse]), lambda b: b <= value)) if coarse else F.lit(0)
    fine = F.array(*[F.array(*[F.lit(b) for b in bounds[i:i + 64]]) for i in range(0, len(bounds), 64)]) if coarse else None
    inside = (F.when(block > 0, (block - 1) * 64 + F.size(F.filter(F.get(fine, block - 1), lambda b: b <= value)))
              .otherwise(F.lit(0)) if coarse else F.lit(0))
    return F.when(value.isNull(), F.lit(len(bounds))).otherwise(inside).cast("int")


def with_next(docs: DataFrame, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """Documents (doc_id, text) with the text that follows in ascending doc_id; the first
    follows the last.

    Null text is empty, null ids come last, rows with one id go by text, a single row follows
    itself. Rows are dealt to ranges of doc_id found as quantiles (at most MOST_BUCKETS
    numbers); each range is sorted on its own, and a copy of the next range's first row is
    added to it, so no row needs a window over the whole table.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    n = rows.count()
    buckets = min(MOST_BUCKETS, -(-n // bucket_rows))
    bounds = []
    if buckets > 1:
        cuts = F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 10 * buckets)
        bounds = sorted(set(rows.agg(cuts).first()[0] or []))
    ranged = rows.withColumn("bucket", bucket_of(F.col("doc_id"), bounds))
    order = [F.col("doc_id").asc_nulls_last(), F.col("text")]
    # the first row of each range: the id from ids alone, then the text of the rows that have it
    first = write_table(ranged.groupBy("bucket").agg(F.min("doc_id").alias("least")), "firsts")
    head = (ranged.join(first, "bucket").where(F.col("doc_id").eqNullSafe(F.col("least")))
            .groupBy("bucket", "doc_id").agg(F.min("text").alias("text")))
    ring = Window.orderBy("bucket")  # a row per range
    heads = write_table(head.withColumn("into", F.coalesce(F.lag("bucket").over(ring), F.max("bucket").over(
        ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))), "heads")
    guests = heads.select("doc_id", "text", F.col("into").alias("bucket"), F.lit(True).alias("guest"))
    dealt = ranged.withColumn("guest", F.lit(False)).unionByName(guests)
    within = Window.partitionBy("bucket").orderBy("guest", *order)
    return dealt.withColumn("next_text", F.lead("text").over(within))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next
    per row of documents; see ``with_next`` for nulls, ties and order. An empty table gives an
    empty result. Texts shorter than four characters are not edited."""
    dealt = with_next(docs).withColumn("n_chars", F.char_length("text"))
    tail = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.left("text", F.col("n_chars") - tail), F.left("next_text", tail))
    own = (dealt.withColumn("fingerprint", fingerprint(tree(F.col("text"))))
           .withColumn("edited", edited)
           .withColumn("edited_fingerprint", fingerprint(tree(F.col("edited")))))
    within = Window.partitionBy("bucket").orderBy("guest", F.col("doc_id").asc_nulls_last(), F.col("text"))
    near = (own.withColumn("next_fingerprint", F.lead("fingerprint").over(within)).where(~F.col("guest"))
            .withColumn("set", leaves_of(F.col("fingerprint"))))
    like = lambda other: likeness(F.col("fingerprint"), F.col(other), F.col("set"), leaves_of(F.col(other)))
    return near.select("doc_id", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "fingerprint", "edited_fingerprint", like("edited_fingerprint").alias("near_edited"),
                       like("next_fingerprint").alias("near_next"))


def op8_merkle_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n_chars FROM documents),
n AS (SELECT *, coalesce(lead(text) OVER o, first_value(text) OVER o) AS next_text FROM d
      WINDOW o AS (ORDER BY doc_id NULLS LAST, text)),
e AS (SELECT *, left(text, n_chars - n_chars // 4) || left(next_text, n_chars // 4) AS edited FROM n),
t AS (SELECT *, MARK(text) AS a, MARK(edited) AS b, MARK(next_text) AS c FROM e),
l AS (SELECT *, LEAVES(a) AS la, LEAVES(b) AS lb, LEAVES(c) AS lc FROM t)
SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, a AS fingerprint, b AS edited_fingerprint,
       LIKE_(a, b, la, lb) AS near_edited, LIKE_(a, c, la, lc) AS near_next
FROM l
""".replace("LEAVES(a)", "list_distinct(regexp_extract_all(a[34:], '.{8}'))").replace(
    "LEAVES(b)", "list_distinct(regexp_extract_all(b[34:], '.{8}'))").replace(
    "LEAVES(c)", "list_distinct(regexp_extract_all(c[34:], '.{8}'))").replace(
    "LIKE_(a, b, la, lb)", "LIKENESS").replace("LIKE_(a, c, la, lc)", "LIKE_NEXT")


def _oracle() -> str:
    """The SQL above with its three repeated expressions written out."""
    sql = ORACLE_SQL
    for x in ("text", "edited", "next_text"):
        lines = f"string_split({x}, chr(10))"
        sections = f"list_transform(string_split({x}, chr(10) || chr(10)), lambda s: md5(array_to_string(list_transform(string_split(s, chr(10)), lambda p: md5(p)), '')))"
        marks = (f"array_to_string(list_transform({lines}, lambda p: array_to_string(list_transform("
                 f"regexp_extract_all(p, '[^.\\n]{{1,32}}[.]*|[.]+'), lambda v: left(md5(v), 8)), '')), '')")
        sql = sql.replace(f"MARK({x})", f"md5(array_to_string({sections}, '')) || ':' || {marks}")
    for name, o in (("LIKENESS", "b"), ("LIKE_NEXT", "c")):
        sql = sql.replace(name, f"CASE WHEN left(a, 32) = left({o}, 32) THEN 1.0 WHEN len(la) + len(l{o}) > 0 "
                                f"THEN len(list_intersect(la, l{o})) * 2 / (len(la) + len(l{o})) ELSE 0.0 END")
    return sql


ORACLE_SQL = _oracle()
