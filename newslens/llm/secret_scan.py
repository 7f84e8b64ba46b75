"""Secrets in texts: fixed patterns, and runs that a character Markov model calls random.

Everything is a DataFrame expression. Matches of a pattern are placed by the lengths of the
pieces between them, so one pass over a text gives all spans and nothing is shuffled.

Two bigram models, of random strings and of ordinary identifiers, are trained from labelled
samples (a table of text and label). A run of 20 or more of their characters that has a letter
and a digit, lies in no pattern's span and whose log-likelihood ratio per character and in all
exceeds the thresholds becomes a span of kind ``random``; it may overlap spans of patterns. Runs
are read with hyphens, scored like underscores, and without: a secret may hold or follow one. The model is one array of 66 x 66
ratios, whatever the number of samples; it is all that reaches the driver.

Spans are [start, end) in code points. Defined results: a null text counts as empty and has no
span; no samples give ratios of zero and so no ``random`` span; repeated rows get the same spans;
extra columns are kept, one named like the added column is replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newslens.llm import frames

# The three patterns and least lengths.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_LENGTH = 12
ACCESS = r"AKIA[A-Z0-9]{14,}"  # the same matches as AKIA[A-Z0-9]+ of 18 characters or more
HEX = r"[0-9a-f]{16,}"

KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_="
RUN = r"(?<![A-Za-z0-9+/_=])(?=[A-Za-z+/_=]*[0-9])(?=[0-9+/_=]*[A-Za-z])[A-Za-z0-9+/_=]{20,}"
HYPHENATED = (  # the same with at least one hyphen
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=]*-)(?=[A-Za-z+/_=-]*[0-9])(?=[0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{20,}"
)
IDENTIFIER = r"(?<![A-Za-z0-9+/_=])[A-Za-z_]{8,}(?![A-Za-z0-9+/_=])"
PER_CHARACTER = 0.5
IN_ALL = 12.0
UNIFORM = 0.5  # share of the uniform distribution in the model of random strings
PRIOR = 5.0  # weight of the single characters in both models
SAMPLE_ROWS = 2000
SPAN = "struct<kind:int,start:int,end:int,hit:string>"
_CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _placed(text: Column, pattern: str, kind: int) -> Column:
    """Spans of all matches. Chunks keep the growing arrays short."""
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    pairs = F.zip_with(
        F.split(text, pattern, -1), hits, lambda gap, hit: F.struct(F.length(gap).alias("gap"), hit.alias("hit"))
    )

    def add(acc, pair):
        start = acc["at"] + pair["gap"]
        end = start + F.length(pair["hit"])
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), pair["hit"].alias("hit"))
        return F.struct(end.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    def nothing(at):
        return F.struct(at.alias("at"), F.array().cast(f"array<{SPAN}>").alias("spans"))

    def add_chunk(pairs):
        def step(acc, chunk):
            part = F.aggregate(F.slice(pairs, chunk * _CHUNK + 1, F.lit(_CHUNK)), nothing(acc["at"]), add)
            return _let(
                part, lambda p: F.struct(p["at"].alias("at"), F.concat(acc["spans"], p["spans"]).alias("spans"))
            )

        chunks = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / _CHUNK).cast("int"))
        return F.aggregate(chunks, nothing(F.lit(0)), step)["spans"]

    # the last piece has no match after it
    found = _let(F.filter(pairs, lambda p: p["hit"].isNotNull()), add_chunk)
    return F.when(text.rlike(pattern), found).otherwise(F.array().cast(f"array<{SPAN}>"))


def base_spans(text: Column) -> Column:
    """Spans of the three patterns, by start and then kind."""
    assign = F.filter(
        _placed(text, ASSIGN, 0), lambda s: F.length(F.regexp_extract(s["hit"], ASSIGN, 2)) >= ASSIGN_LENGTH
    )
    return F.concat(assign, _placed(text, ACCESS, 1), _placed(text, HEX, 2))


def _in_order(spans: Column) -> Column:
    def compare(a, b):
        return F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(a["kind"] - b["kind"])

    return F.array_sort(spans, compare)


def labelled_samples(docs: DataFrame, text: str = "text", rows: int = SAMPLE_ROWS) -> DataFrame:
    """text and label (1 random, 0 ordinary) from a bounded sample of documents.

    Values that the patterns find are random, runs of letters and underscores are ordinary.
    Each label takes ``rows`` distinct texts at most, those of the smallest hash. The hashes
    are ranked first, so that only texts of the sample are ever shuffled.
    """
    own = docs.select(F.coalesce(F.col(frames.quoted(text)).cast("string"), F.lit("")).alias("text"))
    own = own.withColumn("order", F.xxhash64("text"))
    any_base = F.col("text").rlike(f"{ASSIGN}|{ACCESS}|{HEX}")

    def sample(part: DataFrame) -> DataFrame:
        last = part.select("order").distinct().orderBy("order").limit(rows).agg(F.max("order")).first()[0]
        kept = part.where(F.col("order") <= last) if last is not None else part.limit(0)
        return kept.groupBy("order").agg(F.min("text").alias("text"))

    secret = sample(own.where(any_base)).select(F.explode(base_spans(F.col("text"))).alias("s"))
    value = F.when(F.col("s.kind") == 0, F.regexp_extract("s.hit", ASSIGN, 2)).otherwise(F.col("s.hit"))
    plain = sample(own).select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("text"))
    return secret.select(value.alias("text"), F.lit(1).alias("label")).unionByName(
        plain.select("text", F.lit(0).alias("label"))
    )


def train(samples: DataFrame, text: str = "text", label: str = "label") -> list[float]:
    """Log-likelihood ratios of all bigrams of ALPHABET, random against ordinary, in one list."""
    chars = F.filter(F.split(F.col(text), ""), lambda c: F.position(c, F.lit(ALPHABET)) > 0)
    rows = samples.where(F.col(text).isNotNull() & F.col(label).isin(0, 1)).select(F.col(label).alias("label"), chars.alias("c"))
    pairs = F.zip_with(F.slice("c", 1, F.greatest(F.size("c") - 1, F.lit(0))), F.slice("c", 2, F.greatest(F.size("c"), F.lit(1))),
                       lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    counts = (
        rows.select("label", F.explode(pairs).alias("p"))
        .where("p.a is not null and p.b is not null")
        .groupBy("label", "p.a", "p.b")
        .count()
        .collect()  # at most 2 * 66 * 66 rows
    )
    number = {c: i for i, c in enumerate(ALPHABET)}
    size = len(ALPHABET)
    n = [[[0.0] * size for _ in range(size)] for _ in range(2)]
    for row in counts:
        n[row["label"]][number[row["a"]]][number[row["b"]]] = float(row["count"])
    if not any(r["label"] for r in counts) or all(r["label"] for r in counts):
        return [0.0] * (size * size)
    # a bigram falls back to how often its second character is used at all
    used = [[sum(n[k][a][b] for a in range(size)) + 0.5 for b in range(size)] for k in range(2)]
    share = [[u / sum(own) for u in own] for own in used]
    out = []
    for a in range(size):
        seen = [sum(n[k][a]) for k in range(2)]
        for b in range(size):
            random, plain = ((n[k][a][b] + PRIOR * share[k][b]) / (seen[k] + PRIOR) for k in (1, 0))
            out.append(math.log(UNIFORM / size + (1 - UNIFORM) * random) - math.log(plain))
    return out


def _ratio(hit: Column, ratios: Column) -> Column:
    """Sum of the ratios of a run's bigrams."""

    def total(codes):
        def add(acc, i):
            return acc + F.element_at(
                ratios, (F.element_at(codes, i) - 1) * len(ALPHABET) + F.element_at(codes, i + 1)
            )

        return F.aggregate(F.sequence(F.lit(1), F.size(codes) - 1), F.lit(0.0), add)

    codes = F.transform(F.split(F.translate(hit, "-", "_"), ""), lambda c: F.position(c, F.lit(ALPHABET)))
    return _let(F.filter(codes, lambda c: c > 0), total)


def random_spans(text: Column, base: Column, ratios: Column) -> Column:
    """Runs that the models call random and that are not wholly inside a span of ``base``."""

    def outside(spans, s):
        return ~F.exists(spans, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    def improbable(s):
        return _let(
            _ratio(s["hit"], ratios),
            lambda r: (r > IN_ALL) & (r > PER_CHARACTER * F.length(s["hit"])),
        )

    hyphenated = F.filter(_placed(text, HYPHENATED, 3), lambda s: outside(base, s) & improbable(s))
    runs = F.filter(_placed(text, RUN, 3), lambda s: outside(base, s) & improbable(s))
    return _let(hyphenated, lambda wide: F.concat(wide, F.filter(runs, lambda s: outside(wide, s))))


def _scanned(packed: DataFrame, ratios: list[float]) -> DataFrame:
    """Packed documents with ``base`` and ``spans`` (base and random), in order."""
    array = F.split(F.lit(",".join(map(repr, ratios))), ",").cast("array<double>")
    text = F.coalesce("text", F.lit(""))
    found = packed.withColumn("base", base_spans(text))
    found = found.withColumn("base", _in_order(F.col("base")))
    found = found.withColumn("more", random_spans(text, F.col("base"), array))
    return found.withColumn("spans", _in_order(F.concat("base", "more"))).drop("more")


def scan(docs: DataFrame, ratios: list[float], *, text: str = "text", spans: str = "secrets") -> DataFrame:
    """All columns with an array of the spans found: kind, start, end and the matched text."""
    found = _scanned(frames.pack(docs, text), ratios)
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = F.transform(
        "spans",
        lambda s: F.struct(F.element_at(names, s["kind"] + 1).alias("kind"), s["start"].alias("start"),
                           s["end"].alias("end"), s["hit"].alias("hit")),
    )
    return frames.unpack(found, text, docs.columns, **{spans: shown})


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def _redacted(text: Column, spans: Column, mask: str) -> Column:
    """``text`` with ``mask`` in place of every stretch that spans cover."""

    def add(acc, s):
        # a span that overlaps what is masked already only moves the end of the mask
        gap = F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask))
        fresh = s["start"] >= acc["at"]
        parts = F.concat(acc["parts"], F.when(fresh, F.array(gap)).otherwise(F.array().cast("array<string>")))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), parts.alias("parts"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    whole = F.aggregate(spans, start, add)
    rest = _let(
        whole,
        lambda w: F.concat(F.array_join(w["parts"], ""), F.substring(text, w["at"] + 1, F.length(text) - w["at"])),
    )
    return F.when(F.size(spans) > 0, rest).otherwise(text)


def redact(
    docs: DataFrame, ratios: list[float], *, text: str = "text", n_chars: str = "n_chars", mask: str = "[SECRET]"
) -> DataFrame:
    """The documents with every secret masked, and their count of characters, if they have one, put right."""
    found = _scanned(frames.pack(docs, text), ratios)
    found = found.withColumn("text", _redacted(F.col("text"), F.col("spans"), mask))
    out = frames.unpack(found, text, docs.columns)
    if n_chars in docs.columns and n_chars != text:
        kind = docs.schema[n_chars].dataType
        masked = F.when(F.size("spans") > 0, F.length("text").cast(kind)).otherwise(F.col("row")[n_chars])
        out = frames.unpack(found.withColumn("row", F.col("row").withField(frames.quoted(n_chars), masked)), text, docs.columns)
    return out


def op2(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = _scanned(frames.pack(docs, "text", ["doc_id"]), train(labelled_samples(docs)))

    def count(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(_joined(F.col("base")), 256).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
    )
