"""Line dedup by a log-template tree, in DataFrame functions alone.

Tokens of a line that hold a digit, ``@`` or ``/`` are variable fields and
masked; a line of such tokens only stays as it is. A fixed-depth tree sorts
the masked lines: by token count, by the first ``depth`` tokens, and then by
each quarter of the other, free tokens: a line is in up to four leaves, each
named by a quarter that holds an unmasked token. In every leaf the line
found in most documents (ties: the larger text) is the anchor; lines that
agree with it in ``similar`` of the free tokens or more share the leaf's
template, in which the other positions are variable. So lines of one template have
a quarter of their free tokens alike, and unlike families never compete for
an anchor. Every line is also a template of its own.

A template recurs if it is found in ``few`` documents or more, or in two
for lines of over ``long`` tokens (whole passages). A line of a recurring
template is dropped from every document but the one with the smallest
doc_id that has the template; of a line's several templates one is enough,
so for every line dropped a line of its template is in an earlier document.

Lines are parsed once. Hashes of lines (of text and tree path, 128 bits
together) are grouped and joined; texts move once, for the distinct lines
whose leaves hold several. Null texts count as empty, blank lines are kept
and not counted. A null doc_id is a document larger than all. Rows that
repeat an id are one document when documents are counted; rows that repeat
id and text get the same result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dbtelemetry.llm import common

DEPTH = 3
QUARTERS = 4
SIMILAR = 0.7
FEW = 5
LONG = 50
_SPACE = r"[\x09-\x0D\x20]+"
_VARIABLE = "[0-9@/]"
_FIELD = "<*>"
#: Stands for a null id: larger than any other.
_LAST = 2**63 - 1


def masked(tokens: Column, line: Column) -> Column:
    """Tokens of a line, variable fields masked; as they are if nothing else is left."""
    mask = F.transform(tokens, lambda t: F.when(t.rlike(_VARIABLE), F.lit(_FIELD)).otherwise(t))
    plain = F.exists(tokens, lambda t: ~t.rlike(_VARIABLE))
    return F.when(line.rlike(_VARIABLE) & plain, mask).otherwise(tokens)


def _lines(docs: DataFrame, id_col: str, text_col: str, depth: int) -> DataFrame:
    """All lines but blank ones: ``doc, th, pos``, their ``n`` masked tokens, joined (``key``), and hashes of lead and line."""
    rows = common.texts(docs, id_col, text_col)
    rows = rows.select(F.coalesce("doc_id", F.lit(_LAST)).alias("doc"), F.xxhash64("text").alias("th"),
                       F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    rows = rows.filter(F.col("line").rlike(r"[^\x09-\x0D\x20]"))
    rows = rows.withColumn("tokens", F.split(F.btrim(F.col("line"), F.lit(" \t\r\x0b\x0c")), _SPACE))
    rows = rows.withColumn("tokens", masked(F.col("tokens"), F.col("line")))
    rows = rows.select("doc", "th", "pos", F.size("tokens").alias("n"), F.array_join("tokens", " ").alias("key"),
                       F.array_join(F.slice("tokens", 1, depth), " ").alias("lead"))
    return rows.select("doc", "th", "pos", "n", "key", F.xxhash64("n", "lead").alias("leaf"), F.xxhash64("key", F.lit(1)).alias("lh"))


def _alike(free: Column, other: Column) -> Column:
    return F.aggregate(F.zip_with(free, other, lambda a, b: (a == b).cast("int")), F.lit(0), lambda s, x: s + x)


def templates(lines: DataFrame, depth: int = DEPTH, similar: float = SIMILAR) -> DataFrame:
    """``leaf, lh, path``: the templates that several distinct lines share, each named by the leaf and its path on."""
    seen = lines.select("leaf", "lh", "doc").distinct().groupBy("leaf", "lh").agg(F.count(F.lit(1)).alias("docs"))
    seen = common.stored(seen)
    shared = seen.groupBy("leaf").count().filter("count > 1").select("leaf")
    # Fewer free tokens than this cannot differ in one and still agree in enough.
    least = depth + next(m for m in range(1, 1000) if m - 1 >= similar * m)
    texts = lines.filter(F.col("n") >= least).select("leaf", "lh", "n", "key").join(shared, "leaf", "left_semi").distinct()
    texts = common.stored(texts.join(seen, ["leaf", "lh"]), "zstd")
    free = F.slice(F.split("key", " ", -1), F.lit(depth + 1), F.col("n") - depth)
    m = F.col("n") - depth
    cut = lambda k: F.floor(k * m / QUARTERS).cast("int")
    quarter = F.explode(F.sequence(F.lit(0), F.lit(QUARTERS - 1)))
    parts = texts.select("leaf", "lh", "docs", "n", free.alias("free"), quarter.alias("k"))
    parts = parts.withColumn("part", F.slice("free", cut(F.col("k")) + 1, cut(F.col("k") + 1) - cut(F.col("k"))))
    parts = parts.filter(F.exists("part", lambda t: ~(t.rlike(_VARIABLE) | (t == _FIELD))))
    parts = common.stored(parts.select("leaf", "lh", F.xxhash64("k", F.array_join("part", " ")).alias("path")))
    several = parts.groupBy("leaf", "path").count().filter("count > 1").select("leaf", "path")
    parts = parts.join(several, ["leaf", "path"], "left_semi").join(texts, ["leaf", "lh"])
    parts = common.stored(parts.select("leaf", "path", "lh", "docs", "n", "key"), "zstd")
    anchor = parts.groupBy("leaf", "path").agg(F.max(F.struct("docs", "key")).alias("top"))
    pair = parts.join(anchor.select("leaf", "path", F.col("top.key").alias("anchor")), ["leaf", "path"])
    rest = lambda c: F.slice(F.split(c, " ", -1), F.lit(depth + 1), F.col("n") - depth)
    return pair.filter(_alike(rest("key"), rest("anchor")) >= F.lit(similar) * m).select("leaf", "lh", "path")


def dropped_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH,
                  similar: float = SIMILAR, few: int = FEW, long: int = LONG) -> DataFrame:
    """``doc, th, pos`` (id, text hash and line number) of the lines that go."""
    lines = common.stored(_lines(docs, id_col, text_col, depth), "zstd")
    narrow = lines.select("doc", "th", "pos", "n", "leaf", "lh")
    shared = narrow.join(templates(lines, depth, similar), ["leaf", "lh"])
    own = narrow.withColumn("path", F.col("lh")).withColumn("own", F.lit(True))
    own = common.stored(own.unionByName(shared.withColumn("own", F.lit(False))).drop("lh"))
    template = ["leaf", "path", "own"]
    per = (own.select(*template, "n", "doc").distinct().groupBy(*template, "n")
           .agg(F.count(F.lit(1)).alias("docs"), F.min("doc").alias("first")))
    again = per.filter((F.col("docs") >= few) | ((F.col("docs") >= 2) & (F.col("n") > long))).select(*template, "first")
    return own.join(again, template).filter("doc <> first").select("doc", "th", "pos").distinct()


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """One row per input row: ``doc_id, n_lines, n_dropped, text`` (the lines that stay)."""
    gone = dropped_lines(docs, id_col, text_col, **kw).groupBy("doc", "th").agg(F.collect_list("pos").alias("gone"))
    rows = common.texts(docs, id_col, text_col).withColumn("_th", F.xxhash64("text"))
    rows = rows.withColumn("_doc", F.coalesce("doc_id", F.lit(_LAST)))
    out = rows.join(gone, (F.col("_doc") == F.col("doc")) & (F.col("_th") == F.col("th")), "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda _, i: ~F.coalesce(F.array_contains("gone", i), F.lit(False)))
    filled = F.size(F.filter(lines, lambda x: x.rlike(r"[^\x09-\x0D\x20]")))
    return out.select("doc_id", filled.cast("long").alias("n_lines"),
                      F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_dropped"),
                      F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"))


def op4_line_dedup(spark, sf_dir: str) -> DataFrame:
    """Every document without the lines of templates that recur in earlier documents."""
    return clean(common.table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, list_filter(regexp_split_to_array(line, '[\x09-\x0D\x20]+'), lambda t: t <> '') AS raw
  FROM l WHERE regexp_matches(line, '[^\x09-\x0D\x20]')),
m AS (
  SELECT doc_id, pos, len(raw) AS n,
         CASE WHEN len(list_filter(raw, lambda t: NOT regexp_matches(t, '[0-9@/]'))) = 0 THEN raw
              ELSE list_transform(raw, lambda t: CASE WHEN regexp_matches(t, '[0-9@/]') THEN '<*>' ELSE t END) END AS tokens
  FROM k),
w AS (SELECT *, array_to_string(tokens, ' ') AS masked, array_to_string(tokens[1:3], ' ') AS lead FROM m),
s AS (
  SELECT n, lead, masked, any_value(tokens[4:]) AS free, count(DISTINCT doc_id) AS docs FROM w GROUP BY n, lead, masked),
q AS (
  SELECT *, array_to_string(part, ' ') AS piece
  FROM (SELECT *, free[1 + k * (n - 3) // 4 : (k + 1) * (n - 3) // 4] AS part FROM s, (SELECT unnest(range(4)) AS k) WHERE n >= 7)
  WHERE len(list_filter(part, lambda t: t <> '<*>' AND NOT regexp_matches(t, '[0-9@/]'))) > 0),
a AS (
  SELECT n, lead, k, piece, first(free ORDER BY docs DESC, masked DESC) AS anchor FROM q GROUP BY n, lead, k, piece HAVING count(*) > 1),
g AS (
  SELECT q.n, q.lead, q.masked, q.k, q.piece FROM q JOIN a USING (n, lead, k, piece)
  WHERE len(list_filter(list_zip(q.free, a.anchor), lambda z: z[1] = z[2])) >= 0.7::DOUBLE * (q.n - 3)),
o AS (
  SELECT w.doc_id, w.pos, n, lead, g.k, g.piece FROM w JOIN g USING (n, lead, masked)
  UNION ALL SELECT doc_id, pos, n, lead, -1, masked FROM w),
p AS (
  SELECT n, lead, k, piece, count(DISTINCT doc_id) AS docs, min(doc_id) AS f FROM o GROUP BY ALL),
d AS (
  SELECT DISTINCT o.doc_id, o.pos FROM o JOIN p USING (n, lead, k, piece)
  WHERE (p.docs >= 5 OR (p.docs >= 2 AND n > 50)) AND o.doc_id <> p.f),
e AS (
  SELECT l.doc_id, count(*) FILTER (WHERE regexp_matches(l.line, '[^\x09-\x0D\x20]')) AS n_lines,
         count(d.pos) AS n_dropped, string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (WHERE d.pos IS NULL) AS kept
  FROM l LEFT JOIN d ON l.doc_id = d.doc_id AND l.pos = d.pos GROUP BY l.doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, n_dropped::BIGINT AS n_dropped, coalesce(kept, '') AS text FROM e
"""
