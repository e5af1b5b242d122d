"""Secret scan with multipart credential linking.

Strong spans are found by pattern. Weak candidates (a login name, a short secret, an
endpoint) are reported only where the parts that complete a credential stand within ``reach``
code points in the same scope (text between blank lines), from the end of the one to the start of
the next: an interval join of identifiers, secrets and endpoints, done as the running greatest
end before a part and the least start behind it, so no pairs are made. DataFrame functions
only; whole texts.

A pattern's matches and the gaps between them come from one ``regexp_extract_all`` and one
``split``; positions are running sums of their lengths in code points, windowed per document.
The texts themselves are never shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import text_key

# fixed values: the base kinds, their patterns and least lengths, in the order of the result
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{16,}"

#: kind, pattern, group whose length counts, least and most length of it, role
KINDS = (
    ("assign", ASSIGN, 1, 12, None, "secret"),
    ("access", ACCESS, 0, 18, None, "id"),
    ("hex", HEX, 0, 16, None, "secret"),
    ("login", r"""(?i:client_?id|user_?name|user|login|account)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})""", 1, 3, None, "id"),
    ("key", ASSIGN, 1, 6, 11, "secret"),
    # words that the base kind does not know: its own least length leaves nothing to it, so none is the most
    ("key", r"""(?i:pwd|auth)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1, 6, None, "secret"),
    ("endpoint", r"""https?://[A-Za-z0-9.:/_-]+""", 0, 10, None, "endpoint"),
    ("break", r"\n[ \t\r]*\n", 0, 0, None, "break"),
)
N_BASE = 3
REACH = 200


def _text(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _hits(kind: int, pattern: str, group: int) -> Column:
    """Array of (kind, number, length of the gap before, of the match, of the group)."""
    p = _text(pattern)
    return F.expr(
        f"case when rlike(_t, {p}) then filter(transform(arrays_zip(split(_t, {p}, -1), regexp_extract_all(_t, {p}, 0), regexp_extract_all(_t, {p}, {group})), "
        f"(x, i) -> named_struct('kind', {kind}, 'i', i, 'gap', length(x.`0`), 'hit', length(x.`1`), 'val', length(x.`2`))), x -> x.hit is not null) end"
    )


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """All spans: doc_id, _key (of the text), copies (equal rows), kind (number in KINDS; null in
    the one row of a document without spans), start, end (code points, end exclusive).

    Null text is empty. Rows equal in ``doc_id`` and text are scanned once and counted in
    ``copies``. Other columns are ignored. An empty table gives no rows."""
    t = F.coalesce(F.col("text"), F.lit(""))
    d = docs.select("doc_id", t.alias("_t"), text_key(t).alias("_key"))
    none = F.expr("cast(array() as array<struct<kind:int,i:int,gap:int,hit:int,val:int>>)")
    parts = [F.coalesce(_hits(k, p, g), none) for k, (_, p, g, _, _, _) in enumerate(KINDS)]
    d = d.select("doc_id", "_key", F.concat(*parts).alias("_hits"))
    d = d.groupBy("doc_id", "_key").agg(F.first("_hits").alias("_hits"), F.count("*").alias("copies"))
    d = d.select("doc_id", "_key", "copies", F.inline_outer("_hits"))
    before = Window.partitionBy("doc_id", "_key", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap").cast("long") + F.col("hit")).over(before)
    d = d.withColumn("end", end).withColumn("start", F.col("end") - F.col("hit"))
    fits = F.lit(False)
    for k, (_, _, _, least, most, _) in enumerate(KINDS):
        fits = fits | ((F.col("kind") == k) & (F.col("val") >= least) & (F.lit(True) if most is None else F.col("val") <= most))
    # a match that fails stays as a row without a kind, so that every document keeps a row
    d = d.withColumn("kind", F.when(fits, F.col("kind")))
    return _link(d, reach)


def _is(role: str) -> Column:
    return F.col("kind").isin([k for k, x in enumerate(KINDS) if x[5] == role])


def _link(d: DataFrame, reach: int) -> DataFrame:
    """Keeps base spans, and weak ones whose complementary parts are within reach."""
    doc = Window.partitionBy("doc_id", "_key").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    d = d.withColumn("_scope", F.sum(F.when(_is("break"), 1).otherwise(0)).over(doc))
    # the gap between two parts: from the end of the one to the start of the other. Running windows
    # both ways, as one that ends with its scope would be summed anew for each row
    scope = Window.partitionBy("doc_id", "_key", "_scope")
    before = scope.orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    behind = scope.orderBy(F.col("start").desc()).rangeBetween(Window.unboundedPreceding, 0)
    for role in ("id", "secret"):
        d = d.withColumn(f"_{role}_end", F.max(F.when(_is(role), F.col("end"))).over(before))
    for role in ("id", "secret"):
        last, first = F.col(f"_{role}_end"), F.min(F.when(_is(role), F.col("start"))).over(behind)
        d = d.withColumn(f"_{role}", F.when((last >= F.col("start") - reach) | (first <= F.col("end") + reach), 1).otherwise(0))
    weak = F.col("kind") >= N_BASE
    complete = F.when(_is("id"), F.col("_secret") == 1).when(_is("secret"), F.col("_id") == 1).when(_is("endpoint"), (F.col("_id") == 1) & (F.col("_secret") == 1))
    # a document whose candidates all fall away keeps one row, without a span
    d = d.withColumn("kind", F.when(~weak | F.coalesce(complete, F.lit(False)), F.col("kind")))
    return d.select("doc_id", "_key", "copies", "kind", "start", "end")


def report(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    s = scan(docs, reach)
    some = F.when(F.col("kind").isNotNull(), F.struct("start", "kind", "end"))
    names = F.array(*[F.lit(k[0]) for k in KINDS])
    line = lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))
    text = lambda spans: F.array_join(F.transform(spans, line), ",")
    n = [F.count(F.when(F.col("kind") == k, 1)).alias(f"n_{KINDS[k][0]}") for k in range(N_BASE)]
    g = s.groupBy("doc_id", "_key", "copies").agg(*n, F.count(F.when(F.col("kind") >= N_BASE, 1)).alias("n_linked"), F.sort_array(F.collect_list(some)).alias("_all"))
    return g.select(
        "doc_id",
        *[f"n_{KINDS[k][0]}" for k in range(N_BASE)],
        F.sha2(text(F.filter("_all", lambda x: x["kind"] < N_BASE)), 256).alias("base_sha256"),
        text(F.col("_all")).alias("spans"),
        "n_linked",
        F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
