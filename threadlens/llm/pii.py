"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from patterns. Three labelers vote on each (yes, no, or no opinion): the strict form of
the pattern, a gazetteer, and the words before the span. Votes are counted per pattern of votes; expectation
maximisation over those counts estimates how reliable each labeler is and how likely each pattern is
a true span. A naive-Bayes span classifier is then trained on all spans with these soft labels,
over the votes and the shape of the span. Base spans are always reported; spans of the further kinds are
reported where the classifier accepts them.

Java's regular expressions recurse on repeated groups and restart at every character of a run. So
single separators between digits or labels first become a mark of one character, which turns each
pattern into runs of one character class, and a match starts only at the start of its run.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadlens.llm.scratch import stored

MARK, OTHER = "", ""
LABEL, LOCAL = "A-Za-z0-9-", r"A-Za-z0-9._%+\-" + MARK


def _run(chars: str) -> str:
    """Start of a run of ``chars``, or the end of the match before."""
    return rf"(?:(?<![{chars}])|\G)"


@dataclass(frozen=True)
class Kind:
    """``guard`` is a cheap necessary condition; ``joints`` are the separators that become the mark;
    ``keeps`` (SQL over ``v``, the match) drops failing matches; the rest are the labelers' yes and no."""

    name: str
    guard: str
    joints: str | None
    pattern: str
    keeps: str
    strict: str
    gazetteer: str
    cues: str
    base: bool = True


DIGITS = "regexp_replace(v, '[^0-9]', '')"
OCTET = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"

KINDS = (
    Kind("email", "@", rf"(?<=[{LABEL}])\.(?=[{LABEL}])",
         rf"{_run(LOCAL)}[{LOCAL}]++@[{LABEL}]++{MARK}[{LABEL}{MARK}]*+", "true",
         r"v rlike '^[A-Za-z0-9][^@]*@[A-Za-z0-9.-]*[.][A-Za-z]{2,24}$'",
         r"v rlike '[.](com|org|net|edu|gov|info|io|de|fr|es|uk|eu)$'", "mail|contact|write|from|an|para|pour"),
    Kind("ip", r"[0-9]\.[0-9]", None,
         rf"{_run('0-9')}[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", rf"v rlike '^{OCTET}([.]{OCTET}){{3}}$'",
         r"not v rlike '(^|[.])0[0-9]'", r"not v rlike '^(0|255)[.]'", "ip|host|server|address|from|client"),
    Kind("card", r"[0-9](?:[ -]?[0-9]){13}", r"(?<=[0-9])[\x20-](?=[0-9])",
         rf"[0-9][0-9{MARK}]*+", f"length({DIGITS}) between 14 and 19 and luhn_check({DIGITS})",
         f"length({DIGITS}) in (14, 15, 16, 19)", f"{DIGITS} rlike '^(4|5[1-5]|3[47]|36|6011|65|2[2-7])'", "card|visa|credit|karte|carte|tarjeta"),
    Kind("phone", r"\+[0-9]", None,
         r"\+[0-9][\x20().0-9-]+[0-9]", f"length({DIGITS}) between 10 and 15",
         r"v rlike '^[+][0-9]{1,3}[ .-]?[(]?[0-9]'", r"v rlike '^[+](1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])'", "phone|call|tel|fax|mobile|anruf"),
    Kind("ssn", r"[0-9]-[0-9]", None,
         r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])", "true",
         r"not v rlike '^(000|666|9)'", r"not v rlike '-00-|-0000$'", "ssn|social|security", base=False),
    Kind("iban", r"[A-Z]{2}[0-9]{2}", None,
         r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])", "true",
         r"v rlike '^[A-Z]{2}[0-9]{2}[A-Z0-9]{4}[0-9]'", r"v rlike '^(DE|FR|ES|GB|IT|NL|BE|AT|CH|PT)'", "iban|konto|account|cuenta|compte", base=False),
)
CONTEXT_CHARS = 24
VOTES = ("strict", "gazetteer", "context")
SHAPES = ("size", "joined")


def _places(kind: Kind, number: int) -> Column:
    """Matches of one kind in the text ``t`` as structs (kind, start, stop, v, before).

    Places follow from the lengths of the matches and of the pieces between them.
    """
    text = F.col("t")
    if kind.joints is not None:
        text = F.regexp_replace(F.translate(text, MARK, OTHER), kind.joints, MARK)
    pieces, matches = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    ends = "array<struct<s:int,e:int>>"

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["g"]
        stop = start + x["n"]
        return F.struct(stop.alias("at"), F.concat(state["out"], F.array(F.struct(start.alias("s"), stop.alias("e")))).alias("out"))

    lengths = F.zip_with(F.slice(pieces, 1, F.size(matches)), matches, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("n")))
    places = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), F.array().cast(ends).alias("out")), step, lambda z: z["out"])

    def span(z: Column) -> Column:
        begin = F.greatest(z["s"] - CONTEXT_CHARS, F.lit(0))
        return F.struct(
            F.lit(number).alias("kind"), z["s"].alias("start"), z["e"].alias("stop"),
            F.substring(F.col("t"), z["s"] + 1, z["e"] - z["s"]).alias("v"), F.substring(F.col("t"), begin + 1, z["s"] - begin).alias("before"))

    guard = F.col("t").contains(kind.guard) if kind.guard == "@" else F.col("t").rlike(kind.guard)
    none = F.array().cast("array<struct<kind:int,start:int,stop:int,v:string,before:string>>")
    return F.when(guard, F.transform(places, span)).otherwise(none)


def _by_kind(values: list[str]) -> Column:
    chosen = F.expr(values[-1])
    for number in range(len(values) - 2, -1, -1):
        chosen = F.when(F.col("kind") == number, F.expr(values[number])).otherwise(chosen)
    return chosen


def candidates(docs: DataFrame) -> DataFrame:
    """(doc_id, h, kind, start, stop, votes, shape): the spans of all kinds with the labelers' votes.

    ``h`` hashes the text, so that rows which share an id but not a text stay apart. Votes are 1, 0
    or -1 for no opinion.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("t"))
    spans = texts.select("doc_id", F.xxhash64("t").alias("h"), F.explode(F.concat(*[_places(k, i) for i, k in enumerate(KINDS)])).alias("x")).select("doc_id", "h", "x.*")
    kept = spans.where(_by_kind([k.keeps for k in KINDS]))
    cues = _by_kind([f"before rlike '(?i)(?:^|[^a-z])(?:{k.cues})[a-z]*[^a-z]*$'" for k in KINDS])
    return kept.select(
        "doc_id", "h", "kind", "start", "stop",
        _by_kind([k.strict for k in KINDS]).cast("int").alias("strict"),
        _by_kind([k.gazetteer for k in KINDS]).cast("int").alias("gazetteer"),
        F.when(cues, 1).when(F.col("before").rlike(r"[=/\\#_]$"), 0).otherwise(-1).alias("context"),
        F.least(F.length("v") / 8, F.lit(3)).cast("int").alias("size"),
        F.col("before").rlike("[A-Za-z0-9]$").cast("int").alias("joined"))


def _log(p: float) -> float:
    return math.log(min(max(p, 1e-9), 1 - 1e-9))


def reliabilities(counts: dict[tuple[int, ...], int], rounds: int = 30) -> dict[tuple[int, ...], float]:
    """P(true span) of each pattern of votes of one kind, by expectation maximisation over its counts.

    Labelers are independent given the truth; each has its own chance of a yes for true and for
    false spans, and abstaining says nothing. It starts from the majority vote.
    """
    chance = {}
    for votes in counts:
        given = [v for v in votes if v >= 0]
        chance[votes] = (sum(given) + 0.5) / (len(given) + 1)
    for _ in range(rounds):
        yes = sum(n * chance[v] for v, n in counts.items())
        total = sum(counts.values())
        prior = (yes + 1) / (total + 2)
        rates = []
        for i in range(len(VOTES)):
            cells = [[2.0, 1.0], [1.0, 2.0]]
            for votes, n in counts.items():
                if votes[i] >= 0:
                    cells[0][votes[i]] += n * (1 - chance[votes])
                    cells[1][votes[i]] += n * chance[votes]
            rates.append([[c / sum(row) for c in row] for row in cells])
        for votes in counts:
            score = _log(prior) - _log(1 - prior)
            score += sum(_log(rates[i][1][v]) - _log(rates[i][0][v]) for i, v in enumerate(votes) if v >= 0)
            chance[votes] = 1 / (1 + math.exp(-max(-30.0, min(30.0, score))))
    return chance


def train(spans: DataFrame) -> dict[int, tuple[float, dict[tuple[str, int], float]]]:
    """Bias and weights per kind of the final classifier.

    All spans count: Spark reduces them to one row per kind, pattern of votes and shape, of which there are at
    most 6 * 27 * 8 whatever the input; only these come to the driver.
    """
    names = [*VOTES, *SHAPES]
    rows = spans.groupBy("kind", *names).agg(F.count("*").alias("n")).collect()
    model = {}
    for kind in range(len(KINDS)):
        own = [r for r in rows if r["kind"] == kind]
        counts: dict[tuple[int, ...], int] = {}
        for r in own:
            key = tuple(r[v] for v in VOTES)
            counts[key] = counts.get(key, 0) + r["n"]
        chance = reliabilities(counts)
        soft = [(r, r["n"] * chance[tuple(r[v] for v in VOTES)], r["n"]) for r in own]
        yes, total = sum(x[1] for x in soft), sum(x[2] for x in soft)
        weights = {}
        for name in names:
            values = sorted({r[name] for r in own})
            for value in values:
                a = sum(y for r, y, _ in soft if r[name] == value)
                n = sum(t for r, _, t in soft if r[name] == value)
                weights[name, value] = math.log((a + 1) / (yes + len(values))) - math.log((n - a + 1) / (total - yes + len(values)))
        model[kind] = math.log((yes + 1) / (total - yes + 1)), weights
    return model


def classify(spans: DataFrame, model: dict[int, tuple[float, dict[tuple[str, int], float]]]) -> DataFrame:
    """``spans`` with ``accepted``: the classifier finds a true span likelier than not."""
    score = F.lit(0.0)
    for kind, (bias, weights) in model.items():
        own = F.lit(bias)
        for (name, value), weight in sorted(weights.items()):
            own = own + F.when(F.col(name) == value, weight).otherwise(0.0)
        score = F.when(F.col("kind") == kind, own).otherwise(score)
    return spans.withColumn("accepted", score >= 0)


def find_pii(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_accepted): one row per row of ``docs(doc_id, text)``.

    ``spans`` is ``kind:start:end`` by start, then kind (code points, end exclusive): all base spans, and those of
    the further kinds that the classifier accepts; ``n_accepted`` counts spans of any kind that it accepts.
    Null and empty texts have no spans; repeated rows get equal rows; other columns are ignored; no documents
    give no rows. Texts are read once and never shuffled.
    """
    spans = stored(candidates(docs), "pii-spans")
    judged = classify(spans, train(spans)).where(F.col("accepted") | F.col("kind").isin([i for i, k in enumerate(KINDS) if k.base]))
    per_doc = judged.groupBy("doc_id", "h").agg(F.sort_array(F.collect_set(F.struct("start", "kind", "stop", "accepted"))).alias("spans"))
    keys = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h")).alias("k")
    per_doc = per_doc.alias("s")
    joined = keys.join(per_doc, (F.col("k.doc_id").eqNullSafe(F.col("s.doc_id"))) & (F.col("k.h") == F.col("s.h")), "left")
    names = F.array(*[F.lit(k.name) for k in KINDS])
    spans_or_none = F.coalesce("s.spans", F.array().cast("array<struct<start:int,kind:int,stop:int,accepted:boolean>>"))
    rows = joined.select(F.col("k.doc_id").alias("doc_id"), spans_or_none.alias("x"))

    def written(chosen: Column) -> Column:
        return F.array_join(F.transform(chosen, lambda z: F.concat_ws(":", names[z["kind"]], z["start"], z["stop"])), ",")

    def of_kinds(wanted: list[int]) -> Column:
        return F.filter("x", lambda z: z["kind"].isin(wanted))

    base = [i for i, k in enumerate(KINDS) if k.base]
    return rows.select(
        "doc_id",
        *[F.size(of_kinds([i])).cast("long").alias(f"n_{KINDS[i].name}") for i in base],
        F.sha2(written(of_kinds(base)), 256).alias("base_sha256"),
        written(F.col("x")).alias("spans"),
        F.size(F.filter("x", lambda z: z["accepted"])).cast("long").alias("n_accepted"))
