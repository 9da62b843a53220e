"""Operator 12, secret scans: rules, and character Markov models beside them (DataFrame functions only).

Base spans are the rules' matches. A text is cut by each rule's pattern into
matches and the gaps between them; running sums of their lengths give the
positions, so no text is searched twice from its start and its length costs no more
than in proportion. All matches take part in the running sum, also those
that a rule then drops as too short: a dropped match has still consumed its text.

Beyond the rules, every unbroken run of ``[A-Za-z0-9+/_=-]`` of ``TOKEN`` characters or more is
scored by two character Markov models of order 1, one of random strings and one of
ordinary identifiers. A run whose log-likelihood ratio passes
``LOG_RATIO`` is a span of kind ``random`` unless a base span overlaps it. Both models are
counted from labelled samples, each distinct string once. Random: the values of all base spans and
strings drawn from a hash. Ordinary: the words of one case of whole texts (:func:`ordinary`),
from about ``ORDINARY_DOCS`` documents chosen by a hash of their text. A model
is at most 96 x 96 numbers, the only thing that reaches the driver; it goes
back as a constant array in the scoring expression.

Defined cases: NULL text counts as empty; a text without spans has empty
``spans`` and the digest of the empty string. Every row is scanned by
itself, so repeated rows and repeated or NULL ids each get their row. Without any
identifier or random string a model is uniform. Extra columns are ignored; an empty table gives
an empty table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import id_text, stage

#: Kind, pattern, part of the match whose length counts, least length. Letters of the
#: first pattern's names count in either case.
NAMES = "password|passwd|secret|token|api_?key"
HEAD = rf"""(?i:{NAMES})["']?\x20*[:=]\x20*["']?"""
KINDS = ("assign", "access", "hex", "random")
ACCESS_LEAST, HEX_LEAST, VALUE_LEAST = 18, 16, 12
#: All matches of a kind, also those too short where they matter: the runs of the second to fourth pattern end
#: where their characters end, so a shorter match could not have hidden a longer one.
PATTERNS = (HEAD + r"[A-Za-z0-9+/_.=-]+", rf"AKIA[A-Z0-9]{{{ACCESS_LEAST - 4},}}", rf"[0-9a-f]{{{HEX_LEAST},}}")

#: Shortest run that the models judge.
TOKEN = 16
RUN = rf"[A-Za-z0-9+/_=-]{{{TOKEN},}}"
#: Log-likelihood ratio (nats) from which a run counts as random: the odds of an ordinary one, about 1 in 160,000.
LOG_RATIO = 12.0
#: Weight of the uniform distribution in a model's row, in observations.
SMOOTHING = 8.0
#: Random strings drawn per alphabet.
DRAWN = 4000
#: Documents whose words are the ordinary identifiers (expected number, chosen by hash), and such a word.
ORDINARY_DOCS = 4000
WORD = "^[A-Z]?[a-z]+([_-][a-z]+)*$"
FIRST, SPAN = 32, 96  # characters from the blank on


def _cut(text: Column, pattern: str, kind: int) -> Column:
    """Matches of a pattern, each with the length of the gap before it."""
    gaps = F.transform(F.split(text, pattern, -1), F.length)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.filter(F.arrays_zip(gaps.alias("gap"), found.alias("found")), lambda z: z["found"].isNotNull())
    rows = F.transform(both, lambda z, i: F.struct(F.lit(kind).alias("kind"), i.alias("k"), z["gap"].alias("gap"), z["found"].alias("found")))
    return F.when(text.rlike(pattern), rows)


def candidates(docs: DataFrame) -> DataFrame:
    """``row, doc_id, kind, start, stop, found`` of every match that passes, and per document one row of kind -1.

    Matches are dealt by row, and positions are running sums within one row and kind.
    """
    d = id_text(docs).withColumn("row", F.monotonically_increasing_id())
    none = F.struct(F.lit(-1).alias("kind"), F.lit(0).alias("k"), F.lit(0).alias("gap"), F.lit("").alias("found"))
    cuts = [_cut(F.col("text"), p, kind) for kind, p in enumerate((*PATTERNS, RUN))]
    empty = F.array(none)
    every = F.concat(empty, *[F.coalesce(c, F.slice(empty, 1, 0)) for c in cuts])
    rows = d.select("row", "doc_id", F.explode(every).alias("c")).select("row", "doc_id", "c.*").repartition("row")
    so_far = Window.partitionBy("row", "kind").orderBy("k").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("stop", F.sum(F.col("gap").cast("long") + F.length("found")).over(so_far))
    value = F.regexp_replace("found", "^" + HEAD, "")  # the whole match begins with the head
    passes = (F.col("kind") != 0) | (F.length(value) >= VALUE_LEAST)
    return rows.filter(passes).select("row", "doc_id", "kind", (F.col("stop") - F.length("found")).alias("start"), "stop", "found")


def _mark_touched(found: DataFrame) -> DataFrame:
    """``touched``: a base span overlaps the row's span. Two running extremes over the sorted spans."""
    base = F.col("kind").between(0, 2)
    up = Window.partitionBy("row").orderBy("start", "kind").rowsBetween(Window.unboundedPreceding, 0)
    down = Window.partitionBy("row").orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, 0)
    ended = F.max(F.when(base, F.col("stop"))).over(up)  # spans that start no later
    begins = F.min(F.when(base, F.col("start"))).over(down)  # spans that start no earlier
    return found.withColumn("__e", ended).withColumn("__b", begins).withColumn(
        "touched", F.coalesce(F.col("__e") > F.col("start"), F.lit(False)) | F.coalesce(F.col("__b") < F.col("stop"), F.lit(False))).drop("__e", "__b")


def drawn(spark: SparkSession, n: int = DRAWN) -> DataFrame:
    """Labelled random strings ``text, random``, drawn by hash: base64, capitals with digits, hex and decimal digits."""
    ids = spark.range(n)

    def digest(salt: str) -> Column:
        return F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")), 256)
    b64 = F.regexp_replace(F.base64(F.unhex(digest("b"))), "=", "")
    # capitals and digits: of four base64 digests the characters of that alphabet
    caps = F.regexp_replace(F.concat(*[F.base64(F.unhex(digest(f"c{k}"))) for k in range(4)]), "[^A-Z0-9]", "")
    digits = F.regexp_replace(digest("d"), "[^0-9]", "")
    kinds = F.explode(F.array(b64, F.substring(caps, 1, 40), F.substring(digest("h"), 1, 40), digits))
    return ids.select(kinds.alias("text"), F.lit(True).alias("random"))


def found_values(found: DataFrame) -> DataFrame:
    """Labelled random strings ``text, random``: the values of a table's base spans."""
    value = F.when(F.col("kind") == 0, F.regexp_replace("found", "^" + HEAD, "")).otherwise(F.col("found"))
    return found.filter(F.col("kind").between(0, 2)).select(value.alias("text"), F.lit(True).alias("random")).distinct()


def ordinary(docs: DataFrame, n_docs: int, wanted: int = ORDINARY_DOCS) -> DataFrame:
    """Labelled identifiers ``text, random``: distinct words of small letters, the first perhaps a capital,
    joined by ``_`` or ``-``, of whole texts. ``n_docs`` is the number of rows of ``docs``."""
    share = min(1.0, wanted / max(1, n_docs))
    chosen = id_text(docs).filter(F.pmod(F.xxhash64("text"), F.lit(1 << 30)) < F.lit(round(share * (1 << 30))))
    words = chosen.select(F.explode(F.split("text", "[^A-Za-z0-9+/_=-]+")).alias("text"))
    return words.filter(F.col("text").rlike(WORD)).select("text", F.lit(False).alias("random")).distinct()


def train(labelled: DataFrame) -> list[float]:
    """Log ratios of both models' transitions, ``SPAN x SPAN`` by previous and next character.

    Capitals behave like small letters in ordinary identifiers, so the identifier model also counts each of
    its transitions in capitals, at a twentieth.
    """
    chars = F.split("text", "")
    pairs = F.arrays_zip(F.slice(chars, 1, F.size(chars) - 1).alias("a"), F.slice(chars, 2, F.size(chars) - 1).alias("b"))
    seen = (labelled.filter(F.length("text") > 1).select("random", F.explode(pairs).alias("p"))
            .groupBy("random", F.ascii("p.a").alias("a"), F.ascii("p.b").alias("b")).agg(F.count("*").alias("n")).collect())
    count = {True: [[0.0] * SPAN for _ in range(SPAN)], False: [[0.0] * SPAN for _ in range(SPAN)]}
    for r in seen:  # at most 2 * SPAN * SPAN rows
        a, b = r["a"] - FIRST, r["b"] - FIRST
        if 0 <= a < SPAN and 0 <= b < SPAN:
            count[r["random"]][a][b] += r["n"]
            if not r["random"]:
                big_a, big_b = ord(chr(r["a"]).upper()) - FIRST, ord(chr(r["b"]).upper()) - FIRST
                count[False][big_a][big_b] += r["n"] / 20
    letters = 66  # characters that a run may hold

    def log_p(table, a, b):
        return math.log((table[a][b] + SMOOTHING / letters) / (sum_of[id(table)][a] + SMOOTHING))
    sum_of = {id(t): [math.fsum(row) for row in t] for t in count.values()}
    return [log_p(count[True], a, b) - log_p(count[False], a, b) for a in range(SPAN) for b in range(SPAN)]


def log_ratio(run: Column, weights: list[float]) -> Column:
    """Sum of the transitions' log ratios of a string of plain ASCII characters."""
    table = F.split(F.lit(",".join(map(repr, weights))), ",").cast("array<double>")  # folded to one constant array
    start = F.struct(F.lit(-1).alias("at"), F.lit(0.0).alias("sum"))

    def step(acc: Column, c: Column) -> Column:
        here = F.ascii(c) - FIRST
        gain = F.when(acc["at"] < 0, F.lit(0.0)).otherwise(F.get(table, acc["at"] * SPAN + here))
        return F.struct(here.alias("at"), (acc["sum"] + gain).alias("sum"))
    return F.aggregate(F.split(run, ""), start, step)["sum"]


def _joined(spans: Column) -> Column:
    """``kind:start:end`` by start, then kind as listed."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def scan(docs: DataFrame, labelled: DataFrame | None = None) -> DataFrame:
    """Per document: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``.

    ``labelled(text, random)`` are further labelled samples for the models.
    """
    found = stage(_mark_touched(candidates(docs)), "candidates")
    sample = found_values(found).unionByName(drawn(docs.sparkSession)).unionByName(ordinary(docs, found.filter("kind = -1").count()))
    weights = train(sample if labelled is None else sample.unionByName(labelled.select("text", "random")))
    random = (F.col("kind") == 3) & ~F.col("touched")
    kept = found.filter((F.col("kind") < 3) | random)
    kept = kept.withColumn("ratio", F.when(random, log_ratio(F.col("found"), weights))).filter((F.col("kind") < 3) | (F.col("ratio") > LOG_RATIO))
    span = F.struct("start", "kind", "stop")

    def number(kind: int) -> Column:
        return F.count(F.when(F.col("kind") == kind, 1))
    by = kept.groupBy("row", "doc_id").agg(
        number(0).alias("n_assign"), number(1).alias("n_access"), number(2).alias("n_hex"),
        F.collect_list(F.when(F.col("kind") >= 0, span)).alias("all"))
    base = F.filter("all", lambda s: s["kind"] < 3)
    return by.select("doc_id", "n_assign", "n_access", "n_hex", F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
                     _joined(F.col("all")).alias("spans"))
