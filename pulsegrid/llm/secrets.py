"""Secret scanning through a trigram index (built-in functions only)."""

from __future__ import annotations

from re import _constants as rx
from re import _parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import require, stored


class Rule(NamedTuple):
    """Matches of ``pattern`` count when group ``group`` has ``least`` code points or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed patterns.  ``{32,}`` and ``{12,}`` find the same spans as ``+`` with a
#: length test afterwards, because both runs are maximal.
BASE_RULES = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]{12,}", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
MORE_RULES = (
    Rule("github", r"gh[opsru]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
MOST_STRINGS = 64


def _required(tree) -> tuple[set[str] | None, set[str] | None]:
    """(all strings the tree matches, strings of which each match holds one); None: unknown."""
    run: set[str] | None = {""}
    best: set[str] | None = None
    whole = True

    def flush() -> None:
        nonlocal best, run
        if run and min(map(len, run)) >= 3 and (best is None or min(map(len, run)) > min(map(len, best))):
            best = run
        run = {""}

    for op, arg in tree:
        exact, must = None, None
        if op is rx.LITERAL:
            exact = {chr(arg).lower()}
        elif op is rx.IN and all(o is rx.LITERAL for o, _ in arg) and len(arg) <= 8:
            exact = {chr(a).lower() for _, a in arg}
        elif op is rx.SUBPATTERN:
            exact, must = _required(arg[-1])
        elif op is rx.BRANCH:
            each = [_required(x) for x in arg[1]]
            exact = set().union(*[e for e, _ in each]) if all(e is not None for e, _ in each) else None
            best_of = [e if e is not None and min(map(len, e)) >= 3 else m for e, m in each]
            must = set().union(*best_of) if all(best_of) else None
        elif op in (rx.MAX_REPEAT, rx.MIN_REPEAT):
            low, high, inner = arg
            inside, must = _required(inner)
            if (low, high) == (0, 1) and inside is not None:
                exact = inside | {""}
            elif low == high and low <= 8 and inside is not None and len(inside) == 1:
                exact = {next(iter(inside)) * low}
            must = must if low > 0 else None
        if exact is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = {a + b for a in run for b in exact}
            continue
        whole = False
        flush()
        if exact is not None:
            run = exact
        elif must and (best is None or min(map(len, must)) > min(map(len, best))):
            best = must
    if whole:
        return run, run if min(map(len, run)) >= 3 else None
    flush()
    return None, best


def trigram_query(pattern: str) -> list[frozenset[str]]:
    """OR of ANDs: each match holds, in lower case, all trigrams of one of the sets.

    Empty when the pattern has no mandatory trigram; such rules scan every text.
    """
    strings = _required(_parser.parse(pattern))[1] or set()
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def postings(docs: DataFrame, trigrams: list[str], id_col: str, text_col: str) -> DataFrame:
    """The inverted index, over the trigrams that the rules ask for: (trigram, id)."""
    low = docs.select(F.col(id_col).alias("id"), F.lower(F.coalesce(F.col(text_col), F.lit(""))).alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains(F.col("low"), F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select("id", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], id_col: str, text_col: str) -> DataFrame:
    """(id, rules whose query the id's postings satisfy)."""
    spark = docs.sparkSession
    clauses = [(t, r.kind, i, 1 << k, (1 << len(s)) - 1) for r in rules for i, s in enumerate(trigram_query(r.pattern)) for k, t in enumerate(sorted(s))]
    wanted = sorted({c[0] for c in clauses})
    if not wanted:
        return docs.select(F.col(id_col).alias("id"), F.array().cast("array<string>").alias("rules")).limit(0)
    asked = spark.createDataFrame(clauses, "trigram string, kind string, clause int, bit long, need long")
    # asked is as large as the rules' patterns, whatever the data's size
    hits = postings(docs, wanted, id_col, text_col).join(F.broadcast(asked), "trigram")
    met = hits.groupBy("id", "kind", "clause").agg(F.bit_or("bit").alias("have"), F.first("need").alias("need")).filter("have = need")
    return met.groupBy("id").agg(F.collect_set("kind").alias("rules"))


#: Matches that are laid one after the other before they join the rest.
STRETCH = 256
_SPANS = "array<struct<start:int,end:int>>"


def _let(value: Column, body) -> Column:
    """``body(value)``, with the value computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spans(text: Column, rule: Rule) -> Column:
    """Code-point spans of the rule's matches, by the lengths of matches and of what lies between.

    Matches are added up in stretches of ``STRETCH``, so that a text of very
    many matches does not copy all of them for each further one.
    """
    pattern = F.lit(rule.pattern)
    zipped = F.arrays_zip(
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("m"),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)).alias("v"),
        F.split(text, rule.pattern, -1).alias("gap"),
    )

    def start(at: Column, kind: str) -> Column:
        return F.struct(at.alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.length(x["m"])
        span = F.array(F.struct(begin.alias("start"), end.alias("end")))
        good = F.length(x["v"]) >= rule.least
        # the last gap has no match after it
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(end.alias("at"), F.when(good, F.concat(acc["out"], span)).otherwise(acc["out"]).alias("out")))

    def stretches(z: Column) -> Column:
        def stretch(acc: Column, k: Column) -> Column:
            some = F.aggregate(F.slice(z, k * STRETCH + 1, F.lit(STRETCH)), start(acc["at"], _SPANS), step)
            return _let(some, lambda s: F.struct(s["at"].alias("at"), F.concat(acc["out"], F.array(s["out"])).alias("out")))

        numbers = F.sequence(F.lit(0), F.floor((F.size(z) - 1) / STRETCH).cast("int"))
        return F.aggregate(numbers, start(F.lit(0), f"array<{_SPANS}>"), stretch, lambda acc: F.flatten(acc["out"]))

    return F.when(F.regexp_like(text, pattern), _let(zipped, stretches)).otherwise(F.array().cast(_SPANS))


def _named(rank: int, rule: Rule) -> Column:
    spans = _spans(F.col("_text"), rule)
    if trigram_query(rule.pattern):
        spans = F.when(F.array_contains("rules", rule.kind), spans)
    named = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(rule.kind).alias("kind")))
    return F.coalesce(named, F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>"))


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: the id, the text and ``spans``, an array of
    (start, rank of the kind, end, kind) in that order.

    Null texts count as empty.  Rows that share an id share the index's
    candidates, which only adds texts to verify; so do rows of null ids.  Spans
    of different kinds may overlap; spans of one kind do not.  The candidates
    are written first: Spark knows their size then and sends them to the texts
    where they are few, so that only their own rules are tried on them.
    """
    require(docs, id_col, text_col)
    cand = stored(candidates(docs, rules, id_col, text_col))
    rows = docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    joined = rows.join(cand, rows[id_col].eqNullSafe(cand["id"]), "left")
    each = [_named(rank, rule) for rank, rule in enumerate(rules)]
    return joined.select(F.col(id_col), F.col("_text").alias("text"), F.array_sort(F.flatten(F.array(*each))).alias("spans"))


def redact(scanned: DataFrame, mark: str = "[secret]") -> DataFrame:
    """Replace every span of ``scan_secrets``' rows by ``mark``; overlapping spans merge."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        before = F.when(s["start"] >= acc["at"], F.concat(F.col("text").substr(acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], before).alias("out"))

    clean = F.aggregate("spans", start, step, lambda acc: F.concat(acc["out"], F.col("text").substr(acc["at"] + 1, F.length("text"))))
    return scanned.withColumn("text", clean).drop("spans")
