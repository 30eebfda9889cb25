"""Secret scan in DataFrame functions only: base patterns plus two character Markov models.

Base spans come from three patterns (see ``KINDS``). Besides them, every
long token is scored by two first-order character Markov models, one of
random strings and one of ordinary identifiers; a token whose mean
log-likelihood ratio per transition exceeds a margin, and which touches no
base span, is a ``markov`` span. The models are transition counts, smoothed
towards the rates of single characters, trained from labelled tokens: by default those of a
bounded sample of documents (``SAMPLE_DOCS``), where base matches are the
random strings and words the ordinary identifiers. Every document is scanned
whole.

Positions are code points, end exclusive. Spark's regex functions return
texts, not places, so places are summed up from the pieces between the
matches (``split``) and the matches themselves. Running values over the
spans of a text are taken in two levels (``_running``), overlaps by binary
search and masked texts from blocks of the text, so that a text with very
many spans costs about as much per span as one with few.

Defined cases: NULL text is the empty text and has no spans; without
labelled tokens of both classes the models add nothing; repeated rows are
scanned each; an empty table gives an empty result. ``redact`` keeps all other columns,
whatever their names; the report does not read them.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from critiq.llm.columns import fresh_name

# Kinds in order, their patterns, and the least length of the tested group.
KINDS = ["assign", "access", "hex", "markov"]
ASSIGN = (r"""(?=[pstaPSTA])(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_LEAST = 12
# a run of one character class is matched whole, so its least length can sit in the pattern
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
WORD = r"[A-Za-z][A-Za-z_]{3,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_-"

SAMPLE_DOCS = 10_000
SMOOTHING = 5.0  # weight of the single-character rates in each transition's rate
MARGIN = 0.7
MASK = "[REDACTED]"

SPAN = "struct<start:int,kind:int,end:int,token:string>"
_SLICE = 64  # items whose running values are taken together
_BLOCK = 4096  # code points of a block that a masked text is put together from
_HALVES = [1 << k for k in reversed(range(28))]  # a text of 2 GiB has fewer spans than their sum


def _bound(value: Column, use) -> Column:
    """``use(value)`` with the value taken once, however often it is used in lambdas."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _running(items: Column, first: Column, after, emit, item_kind: str, out_kind: str) -> Column:
    """Array of ``emit(at, item)``, where ``at`` is ``first`` and then ``after(at, item)``; ``items`` must not be empty.

    An aggregate copies its array with every item it adds, so the items are
    cut into slices: one aggregate finds the value before each slice, then
    one per slice emits its rows.
    """
    def grown(acc: Column, at: Column, row: Column) -> Column:
        return F.struct(at.alias("at"), F.concat(acc["out"], F.array(row)).alias("out"))

    def begun(at: Column, kind: str) -> Column:
        return F.struct(at.alias("at"), F.array().cast(f"array<{kind}>").alias("out"))

    places = F.sequence(F.lit(0), F.floor((F.size(items) - 1) / _SLICE).cast("int"))
    slices = _bound(items, lambda x: F.transform(places, lambda i: F.slice(x, i * _SLICE + 1, F.lit(_SLICE))))
    slices = F.aggregate(
        slices, begun(first, f"struct<at:int,items:array<{item_kind}>>"),
        lambda acc, x: grown(acc, F.aggregate(x, acc["at"], after), F.struct(acc["at"].alias("at"), x.alias("items"))),
        lambda acc: acc["out"])
    return F.flatten(F.transform(slices, lambda x: F.aggregate(
        x["items"], begun(x["at"], out_kind), lambda acc, y: grown(acc, after(acc["at"], y), emit(acc["at"], y)),
        lambda acc: acc["out"])))


def _matches(text: Column, pattern: str, kind: int, tested: int = 0) -> Column:
    """Spans of all leftmost non-overlapping matches; ``token`` is group ``tested``."""
    pieces = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tokens = F.regexp_extract_all(text, F.lit(pattern), F.lit(tested)) if tested else found
    parts = F.zip_with(pieces, F.arrays_zip(found.alias("m"), tokens.alias("t")),
                       lambda p, m: F.struct(F.length(p).alias("gap"), F.length(m["m"]).alias("len"),
                                             m["t"].alias("token")))
    parts = F.filter(parts, lambda x: x["len"].isNotNull())  # the piece after the last match has none

    def span(at: Column, x: Column) -> Column:
        start = at + x["gap"]
        return F.struct(start.alias("start"), F.lit(kind).alias("kind"), (start + x["len"]).alias("end"),
                        x["token"].alias("token"))

    spans = _running(parts, F.lit(0), lambda at, x: at + x["gap"] + x["len"], span,
                     "struct<gap:int,len:int,token:string>", SPAN)
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Array of (start, kind, end, token) of the three base kinds; kind is the place in ``KINDS``."""
    assign = F.filter(_matches(text, ASSIGN, 0, 1), lambda s: F.length(s["token"]) >= ASSIGN_LEAST)
    return F.concat(assign, _matches(text, ACCESS, 1), _matches(text, HEX, 2))


def _place(char: Column) -> Column:
    """Place of a character in ``ALPHABET`` from 1; 0 for any other."""
    return F.position(char, F.lit(ALPHABET))


def labelled_tokens(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """token, label of the ``sample_docs`` documents with the smallest id hashes.

    1: values of base matches (random strings); 0: words outside them.
    """
    key = F.xxhash64(id_col)
    chosen = (docs.select(id_col).where(F.col(id_col).isNotNull()).distinct()
              .orderBy(key, id_col).limit(sample_docs))
    sample = docs.select(id_col, F.col(text_col).alias("_t")).where(F.col("_t").isNotNull())
    sample = sample.join(F.broadcast(chosen), id_col, "left_semi")  # at most sample_docs ids
    rows = sample.select("_t", base_spans(F.col("_t")).alias("_s"))
    values = F.transform("_s", lambda s: F.struct(s["token"].alias("token"), F.lit(1).alias("label")))
    words = F.transform(F.regexp_extract_all(F.regexp_replace("_t", f"{ASSIGN}|{ACCESS}|{HEX}", " "), F.lit(WORD),
                                             F.lit(0)),
                        lambda w: F.struct(w.alias("token"), F.lit(0).alias("label")))
    return rows.select(F.inline(F.concat(values, words)))


def train_models(samples: DataFrame, smoothing: float = SMOOTHING) -> list[float]:
    """Log-likelihood ratio (random over ordinary) per pair of ``ALPHABET`` characters, row-major.

    ``samples``: token, label (1 random, 0 ordinary). Only the transition
    counts, at most two per pair of characters, reach the driver. Without
    both classes every ratio is 0.
    """
    chars = F.split("token", "")
    pairs = samples.select("label", F.explode(F.zip_with(
        F.slice(chars, F.lit(1), F.greatest(F.size(chars) - 1, F.lit(0))),
        F.slice(chars, F.lit(2), F.greatest(F.size(chars) - 1, F.lit(0))),
        lambda a, b: F.struct(_place(a).alias("a"), _place(b).alias("b"))))
        .alias("p")).where("p.a > 0 and p.b > 0")
    counts = pairs.groupBy("label", "p.a", "p.b").agg(F.count(F.lit(1)).alias("n")).collect()
    k = len(ALPHABET)
    if len({r["label"] for r in counts}) < 2:
        return [0.0] * (k * k)
    seen = [[[0] * k for _ in range(k)] for _ in range(2)]
    for r in counts:
        seen[int(r["label"] == 1)][r["a"] - 1][r["b"] - 1] += r["n"]

    def log_rates(table: list[list[int]]) -> list[list[float]]:
        total = sum(map(sum, table))
        alone = [(sum(row[j] for row in table) + 0.5) / (total + 0.5 * k) for j in range(k)]
        return [[math.log((row[j] + smoothing * alone[j]) / (sum(row) + smoothing)) for j in range(k)] for row in table]

    ordinary, random = map(log_rates, seen)
    return [random[i][j] - ordinary[i][j] for i in range(k) for j in range(k)]


def randomness(token: Column, ratios: list[float]) -> Column:
    """Mean log-likelihood ratio per transition of a token of ``ALPHABET`` characters."""
    table = F.split(F.lit(",".join(f"{r:.6f}" for r in ratios)), ",").cast("array<double>")
    places = F.transform(F.split(token, ""), lambda c: _place(c) - 1)
    n = F.size(places) - 1
    steps = F.zip_with(F.slice(places, F.lit(1), n), F.slice(places, F.lit(2), n),
                       lambda a, b: F.get(table, a * len(ALPHABET) + b))
    return F.aggregate(steps, F.lit(0.0), lambda s, x: s + x) / n


def _touched(span: Column, others: Column) -> Column:
    """Does ``span`` overlap one of ``others`` (ascending, not overlapping each other)? Found by binary search."""
    passed = F.aggregate(F.lit(_HALVES), F.lit(0), lambda at, half: F.when(
        F.get(others, at + half - 1)["end"] <= span["start"], at + half).otherwise(at))
    return F.coalesce(F.get(others, passed)["start"] < span["end"], F.lit(False))


def added_spans(text: Column, assign: Column, ratios: list[float], margin: float = MARGIN) -> Column:
    """``markov`` spans: candidates over the margin that touch no base span.

    ``assign``: the spans of that kind. Those of the other kinds are made of characters of candidates only, so
    a candidate touches one if it holds one.
    """
    return F.filter(_matches(text, CANDIDATE, 3), lambda c: ~c["token"].rlike(f"{ACCESS}|{HEX}")
                    & ~_touched(c, assign) & (randomness(c["token"], ratios) > margin))


def scan(docs: DataFrame, ratios: list[float], text_col: str = "text", margin: float = MARGIN,
         base_col: str = "base_spans", spans_col: str = "spans") -> DataFrame:
    """``docs`` with ``base_col`` (base spans) and ``spans_col`` (with ``markov`` spans): arrays of start, kind, end, token,
    sorted by start, then kind."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    assign = fresh_name(docs, "_assign")
    based = docs.withColumn(base_col, F.array_sort(base_spans(text)))
    based = based.withColumn(assign, F.filter(base_col, lambda s: s["kind"] == 0))
    added = added_spans(text, F.col(assign), ratios, margin)
    return based.withColumn(spans_col, F.array_sort(F.concat(base_col, added))).drop(assign)


def spans_text(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def scan_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_markov per document."""
    ratios = train_models(labelled_tokens(docs, sample_docs, id_col, text_col))
    scanned = scan(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), ratios)

    def count(kind: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return scanned.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                          F.sha2(spans_text(F.col("base_spans")), 256).alias("base_sha256"),
                          spans_text(F.col("spans")).alias("spans"), count(3).alias("n_markov"))


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", mask: str = MASK,
           sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mask`` (overlapping spans by one).

    NULL text stays NULL; texts without spans are unchanged.
    """
    ratios = train_models(labelled_tokens(docs, sample_docs, id_col, text_col))
    base, spans = fresh_name(docs, "_base_spans"), fresh_name(docs, "_spans")
    scanned = scan(docs, ratios, text_col, MARGIN, base, spans)
    text, blocks = F.col(text_col), fresh_name(docs, "_blocks")
    pattern = f"(?s).{{1,{_BLOCK}}}"  # code points
    scanned = scanned.withColumn(blocks, F.when(F.size(spans) > 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))))

    def between(start: Column, end: Column) -> Column:
        first = F.floor(start / _BLOCK).cast("int")
        n = F.floor((end - 1) / _BLOCK).cast("int") - first + 1
        held = F.concat_ws("", F.slice(F.col(blocks), first + 1, F.greatest(n, F.lit(1))))
        return F.when(end > start, F.substring(held, start - first * _BLOCK + 1, end - start)).otherwise("")

    # what lies before each span and after all earlier ones; spans that overlap an earlier one share its mask
    gaps = _running(F.col(spans), F.lit(0), lambda at, s: F.greatest(at, s["end"]), lambda at, s: F.struct(
        at.alias("start"), s["start"].alias("end")), SPAN, "struct<start:int,end:int>")
    gaps = F.filter(gaps, lambda g: g["start"] <= g["end"])
    kept = F.array_join(F.transform(gaps, lambda g: F.concat(between(g["start"], g["end"]), F.lit(mask))), "")
    masked = F.concat(kept, between(F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text)))
    return scanned.withColumn(text_col, F.when(F.size(spans) > 0, masked).otherwise(text)).select(*docs.columns)
