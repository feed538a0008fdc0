"""Line dedup by winnowing (DataFrame functions only).

A line is removed when it lies in a run of ``run`` consecutive lines whose sequence also starts
earlier (in a document with a smaller id, or further up in the same one).  Line hashes are
joined to grams of ``gram`` lines; of every run - gram + 1 consecutive grams the smallest (of
equals the last) is a fingerprint, so each repeated run holds a fingerprint at the same place in
all its copies.  Fingerprints that occur twice are joined back to their positions, extended
both ways to every run around them, and a run is dropped unless it is the first of its kind.
Judged on the input: deleting one run does not save another.

Edge cases: a NULL text has no lines and stays NULL; an empty text is one empty line; documents
shorter than a run are kept; a NULL id sorts first; rows of one id sort by a hash of their text,
and identical rows count as one document and get the same result; an empty table gives an
empty result.  Other columns are kept and never read; ``n_lines`` and ``n_removed`` (in any case)
are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from .common import id_key, stage


def _seq_hash(array: str, start: str, length: int, salt: int | None = None) -> str:
    parts = [f"{array}[{start} + {i}]" for i in range(length)]
    return f"xxhash64({', '.join(([f'{salt}L'] if salt is not None else []) + parts)})"


def _fingerprints(docs: DataFrame, run: int, gram: int) -> DataFrame:
    """(k, th, base, around, fp): winnowed fingerprints with the line hashes of all runs around them."""
    wide = run - gram + 1
    lines = docs.select("k", "th", F.expr("transform(lines, x -> xxhash64(x))").alias("h")).filter(F.size("h") >= run)
    grams = lines.withColumn("g", F.expr(f"transform(sequence(0, size(h) - {gram}), i -> {_seq_hash('h', 'i', gram)})"))
    least = f"array_min(transform(sequence(s, s + {wide - 1}), i -> struct(g[i] as v, -i as at)))"
    picked = grams.withColumn(
        "p", F.explode(F.expr(f"array_distinct(transform(sequence(0, size(g) - {wide}), s -> -{least}.at))"))
    )
    picked = picked.withColumn("base", F.greatest(F.lit(0), F.col("p") + gram - run))
    return picked.select(
        "k", "th", "base", F.expr(f"slice(h, base + 1, least(size(h), p + {run}) - base)").alias("around"),
        F.expr("g[p]").alias("fp"),
    )


def repeated_runs(docs: DataFrame, run: int, gram: int) -> DataFrame:
    """(k, th, spans): line spans [lo, hi) to delete, ascending, from (k, th, lines)."""
    marks = stage(_fingerprints(docs, run, gram), "winnow")
    repeated = marks.groupBy("fp").agg(F.count("*").alias("n")).filter("n > 1").select("fp")
    runs = marks.join(repeated, "fp", "left_semi").select(
        "k", "th", "base", "around", F.explode(F.expr(f"sequence(0, size(around) - {run})")).alias("i")
    ).select(
        "k", "th", (F.col("base") + F.col("i")).alias("start"),
        F.expr(_seq_hash("around", "i", run)).alias("w1"), F.expr(_seq_hash("around", "i", run, salt=7)).alias("w2"),
    )
    runs = stage(runs, "runs")
    own = F.struct("k", "th", "start")
    first = (
        runs.groupBy("w1", "w2").agg(F.min(own).alias("first"), F.max(own).alias("last"))
        .filter("first <> last").select("w1", "w2", "first")
    )
    late = runs.join(first, ["w1", "w2"]).filter(own != F.col("first")).select("k", "th", "start").distinct()
    # runs that touch or overlap become one span
    order = Window.partitionBy("k", "th").orderBy("start")
    islands = late.withColumn("new", F.coalesce((F.col("start") - F.lag("start").over(order) > run).cast("int"), F.lit(1)))
    islands = islands.withColumn("island", F.sum("new").over(order))
    spans = islands.groupBy("k", "th", "island").agg(F.min("start").alias("lo"), (F.max("start") + run).alias("hi"))
    return spans.groupBy("k", "th").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("spans"))


def dedup_lines(docs: DataFrame, run: int = 3, gram: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with later repeated runs of lines deleted, and columns n_lines, n_removed."""
    if not 1 <= gram <= run:
        raise ValueError("a gram has at least one line and at most as many as a run")
    others = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    whole = F.struct(*[F.col(f"`{c}`") for c in others])
    keyed = docs.select(
        id_key(id_col).alias("k"), F.xxhash64(text_col).alias("th"), whole.alias("doc"),
        F.split(text_col, "\n", -1).alias("lines"),
    )
    spans = repeated_runs(keyed.select("k", "th", "lines").filter("lines is not null"), run, gram)
    both = keyed.drop("lines").join(spans, ["k", "th"], "left").withColumn("lines", F.split(F.col(f"doc.`{text_col}`"), "\n", -1))
    kept = F.expr(
        "if(spans is null, lines, flatten(transform(sequence(0, size(spans)), i -> slice(lines,"
        " if(i = 0, 0, spans[i - 1].hi) + 1,"
        " if(i = size(spans), size(lines), spans[if(i = size(spans), 0, i)].lo) - if(i = 0, 0, spans[i - 1].hi)))))"
    )
    both = both.withColumn("kept", kept)
    out = [
        F.when(F.col(f"doc.`{c}`").isNotNull(), F.array_join("kept", "\n")).alias(c) if c.lower() == text_col.lower() else F.col(f"doc.`{c}`").alias(c)
        for c in others
    ]
    n_lines, n_kept = (F.coalesce(F.size(c), F.lit(0)).cast("long") for c in ("lines", "kept"))
    zero = F.col("lines").isNull()
    return both.select(
        *out, F.when(zero, 0).otherwise(n_lines).cast("long").alias("n_lines"),
        F.when(zero, 0).otherwise(n_lines - n_kept).cast("long").alias("n_removed"),
    )


def line_digest(docs: DataFrame, run: int = 3, gram: int = 2) -> DataFrame:
    """doc_id, n_lines, n_removed and the SHA-256 of the kept text (NULL text: of no bytes)."""
    kept = dedup_lines(docs.select("doc_id", "text"), run, gram)
    return kept.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: the same rows by plain windows over all lines
LINE_SQL = """
WITH l AS (
  SELECT doc_id, i, lines[i] AS line FROM (
    SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
    FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))),
r AS (
  SELECT doc_id, i, line, lead(line, 1) OVER w AS b, lead(line, 2) OVER w AS c FROM l
  WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
late AS (
  SELECT doc_id, i FROM r WHERE c IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY line, b, c ORDER BY doc_id, i) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS i FROM late, (SELECT unnest([0, 1, 2]) AS k)),
kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE gone.i IS NULL), '') AS text
  FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i GROUP BY l.doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.text, '')) AS kept_sha256
FROM documents d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""
