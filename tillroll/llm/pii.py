"""Personal data by weak supervision, in DataFrame functions only.

Candidate spans come from patterns. Four labelers vote on each: its format
(checks such as Luhn or number ranges), a gazetteer (domains, number prefixes,
key prefixes), the words before it, and the characters around it; a labeler may
abstain. Expectation-maximisation over the counts of vote patterns estimates
how reliable each labeler is for each kind and how probable each pattern is.
With these probabilities as soft labels a naive Bayes classifier of span
features (length, characters around, share of digits, word before) is trained
over all candidates and decides on those of the further kinds. Spans of the four
base kinds that pass their format check always stay; those that fail it count
in the training and are dropped.

Candidates are kept per document, and the statistics that reach the driver are
bounded (kinds x 3^4 vote patterns, kinds x a few
hundred feature values).

Defined cases: null and empty texts have no spans; spans that overlap a base
span are no candidates; among other candidates that overlap the earlier, then
the longer one stays; without candidates nothing is trained; repeated rows are
judged each; other columns pass through and clashing output names are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillroll.llm.common import settled

BASE = ("email", "ip", "card", "phone")
KINDS = (*BASE, "secret", "number")
LABELERS = ("format", "gazetteer", "context", "around")
MASKS = {"email": "<EMAIL>", "ip": "<IP>", "card": "<CARD>", "phone": "<PHONE>", "secret": "<SECRET>", "number": "<NUMBER>"}

# The patterns of the base kinds. Look-behinds only spare the
# search positions from which the plain pattern cannot match either.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){15,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
SECRET = (
    r"(?i)\b(?:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key|auth)[\"']?\s?[=:]\s?[\"']?[A-Za-z0-9+/_.~-]{6,}+"
    r"|\b(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{20,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk-[A-Za-z0-9]{20,})\b"
)
NUMBER = r"(?<![0-9A-Za-z])(?<![0-9][ .-])[0-9](?:[ -]?[0-9]){8,29}+(?![ .-]?[0-9A-Za-z])"

# Gazetteers and clue words.
TOP_DOMAINS = "com org net edu gov info biz io co de fr es it uk eu nl pl ru cn jp br in ch at be se example"
CLUES = {
    "email": "mail email contact write e-mail",
    "ip": "ip host server address addr from client",
    "card": "card visa mastercard amex credit debit carte karte tarjeta",
    "phone": "phone tel call mobile fax telefon teléfono téléphone whatsapp",
    "secret": "password passwd pwd secret token key login auth credentials",
    "number": "account iban passport ssn id number konto compte cuenta",
}
AGAINST = "version ver v section isbn page pages figure price total chapter order sku"


#: Items that a running fold goes through before it hands on: the work for n items is n times this at most.
BLOCK = 256


def bound(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), use), 1)


def running(items: Column, zero: Column, kind: str, step) -> Column:
    """Outputs, of type ``kind``, of a fold over ``items``: ``step(state, item)`` gives (next state, output).

    Appending to one growing array would copy it for every item. Outputs are
    gathered in blocks instead, so that the work grows with the items.
    """
    def add(a: Column, x: Column) -> Column:
        return bound(step(a["state"], x), lambda r: F.struct(r["state"].alias("state"), F.concat(a["out"], F.array(r["out"])).alias("out")))

    def through(a: Column, some: Column) -> Column:
        empty = F.struct(a["state"].alias("state"), F.array().cast(f"array<{kind}>").alias("out"))
        return F.aggregate(some, empty, add, lambda r: F.struct(r["state"].alias("state"), F.concat(a["out"], F.array(r["out"])).alias("out")))

    def blocks(x: Column) -> Column:
        last = F.floor((F.size(x) - 1) / BLOCK).cast("int")
        cut = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(x, i * BLOCK + 1, F.lit(BLOCK)))
        none = F.struct(zero.alias("state"), F.array().cast(f"array<array<{kind}>>").alias("out"))
        return F.flatten(F.aggregate(cut, none, through, lambda a: a["out"]))

    return bound(items, lambda x: F.when(F.size(x) > 0, blocks(x)).otherwise(F.array().cast(f"array<{kind}>")))


MATCH = "struct<start:int,end:int,match:string,before:string,after:string>"
SPAN = "struct<start:int,back:int,order:int,kind:string,end:int,base:boolean,votes:array<tinyint>,features:array<string>>"
SWEPT = f"struct<s:{SPAN},free:boolean>"
#: Characters before a match that labelers and features look at.
BEFORE = 24


def located(text: Column, pattern: str) -> Column:
    """All matches of ``pattern`` as (start, end, match, before, after): places in
    code points, up to ``BEFORE`` characters before and one after. Work in proportion to the text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)  # one more than matches

    def pairs(f: Column, skip: Column) -> Column:
        following = F.slice(skip, F.lit(2), F.size(skip))
        return F.arrays_zip(f.alias("m"), F.slice(skip, F.lit(1), F.size(f)).alias("skip"), following.alias("then"), F.slice(f, F.lit(2), F.size(f)).alias("next"))

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + F.length(x["skip"])
        end = start + F.length(x["m"])
        before = F.right(F.concat(state["tail"], F.right(x["skip"], F.lit(BEFORE))), F.lit(BEFORE))
        after = F.substring(F.concat(F.substring(x["then"], 1, 1), F.substring(F.coalesce(x["next"], F.lit("")), 1, 1)), 1, 1)
        tail = F.right(F.concat(before, F.right(x["m"], F.lit(BEFORE))), F.lit(BEFORE))
        return F.struct(
            F.struct(end.alias("at"), tail.alias("tail")).alias("state"),
            F.struct(start.alias("start"), end.alias("end"), x["m"].alias("match"), before.alias("before"), after.alias("after")).alias("out"),
        )

    zero = F.struct(F.lit(0).alias("at"), F.lit("").alias("tail"))
    none = F.array().cast(f"array<{MATCH}>")
    return bound(found, lambda f: F.when(F.size(f) > 0, bound(between, lambda s: running(pairs(f, s), zero, MATCH, step))).otherwise(none))


def digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def passes_luhn(number: Column) -> Column:
    """Luhn's check of a string of digits."""
    def add(total: Column, i: Column) -> Column:
        d = F.substring(number, F.length(number) - i, F.lit(1)).cast("int") * F.when(i % 2 == 1, 2).otherwise(1)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(number) - 1), F.lit(0), add) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    """The format check of a kind."""
    if kind == "ip":
        # Leading zeros aside, a part of over three digits exceeds 255.
        return F.forall(F.split(match, r"\."), lambda p: F.regexp_replace(p, "^0+(?=.)", "").rlike("^([0-9]{1,2}|1[0-9][0-9]|2[0-4][0-9]|25[0-5])$"))
    if kind == "card":
        return passes_luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(8, 15)
    if kind == "secret":
        return match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (F.length(match) >= 16)
    if kind == "number":
        return F.length(digits(match)).between(13, 19) & passes_luhn(digits(match))
    return F.lit(True)


def vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("byte")


def gazetteer_vote(kind: str, match: Column) -> Column:
    if kind == "email":
        known = F.lower(F.element_at(F.split(match, r"\."), -1)).isin(*TOP_DOMAINS.split())
        return vote(known, ~known & match.rlike("[0-9]$"))
    if kind == "ip":
        return vote(match.rlike(r"^(?!0|10\.|127\.|192\.168\.|22[4-9]|2[3-5])[0-9]"), match.rlike(r"^(0|127)\."))
    if kind == "card":
        return vote(match.rlike("^(4|5[1-5]|2[2-7]|3[47]|6)"), match.rlike("^(0|1|9)"))
    if kind == "phone":
        return vote(match.rlike(r"^\+(1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"), match.rlike(r"^\+0"))
    if kind == "secret":
        return vote(match.rlike(r"^(AKIA|gh[pousr]_|xox|sk-)") | match.rlike("[=:].*[0-9a-f]{12}"), match.rlike("(?i)(example|changeme|xxxx|your)"))
    return vote(F.lit(False), match.rlike("^(19|20)[0-9]{2}[ -]") | match.rlike("^0+$"))


def context_vote(kind: str, before: Column) -> Column:
    def names(words: str) -> str:
        return r"(?i)\b(" + "|".join(words.split()) + r")\b[^A-Za-z0-9]*$"

    return vote(before.rlike(names(CLUES[kind])), before.rlike(names(AGAINST)))


def described(kind: str, spans: Column) -> Column:
    """Spans of one kind with votes and features."""
    def describe(s: Column) -> Column:
        before, right = s["before"], s["after"]
        left = F.right(before, F.lit(1))
        ok = valid(kind, s["match"])
        free = (left.rlike(r"^[\s(\[<\"'=:,;]?$")) & (right.rlike(r"^[\s)\]>\"',;.!?]?$"))
        size = F.length(s["match"])
        share = F.floor(F.length(digits(s["match"])) * 4 / size)
        word = F.regexp_extract(before, r"([^\s]+)\s*$", 1)
        return F.struct(
            s["start"].alias("start"), (-s["end"]).alias("back"), F.lit(KINDS.index(kind)).alias("order"), F.lit(kind).alias("kind"), s["end"].alias("end"),
            (ok & F.lit(kind in BASE)).alias("base"),
            F.array(vote(ok, ~ok), gazetteer_vote(kind, s["match"]), context_vote(kind, before), vote(free, ~free)).alias("votes"),
            F.array(
                F.concat(F.lit("size "), F.floor(F.log2(size)).cast("string")),
                F.concat(F.lit("digits "), share.cast("string")),
                F.concat(F.lit("left "), character_class(left)),
                F.concat(F.lit("right "), character_class(right)),
                F.concat(F.lit("word "), F.pmod(F.crc32(F.lower(word)), F.lit(64)).cast("string")),
            ).alias("features"),
        )

    return F.transform(spans, describe)


def character_class(c: Column) -> Column:
    return F.when(c == "", "edge").when(c.rlike(r"\s"), "space").when(c.rlike("[0-9]"), "digit").when(c.rlike("[A-Za-z]"), "letter").otherwise("mark")


def candidates(text: Column) -> Column:
    """All candidate spans of a text by start, then the longer one, then the kind."""
    text = F.coalesce(text, F.lit(""))
    possible = {
        "email": text.contains("@"), "ip": text.rlike(r"[0-9]\.[0-9]"), "card": text.rlike(r"[0-9][ -]?[0-9]"),
        "phone": text.contains("+"), "secret": text.rlike("[=:]|AKIA|_|-"), "number": text.rlike(r"[0-9][ -]?[0-9]"),
    }
    none = F.array().cast(f"array<{MATCH}>")
    patterns = dict(zip(KINDS, (EMAIL, IP, CARD, PHONE, SECRET, NUMBER)))
    return F.array_sort(F.concat(*(described(k, F.when(possible[k], located(text, patterns[k])).otherwise(none)) for k in KINDS)))


def only_candidates(spans: Column) -> Column:
    """Base spans, failed base matches, and further spans that overlap none of the base spans.

    ``spans`` are by start. Of the base spans before one, the greatest end tells
    whether any reaches it; of those behind it, the next start.
    """
    def forth(end: Column, s: Column) -> Column:
        base_end = F.when(s["base"], F.greatest(end, s["end"])).otherwise(end)
        return F.struct(base_end.alias("state"), F.struct(s.alias("s"), (s["base"] | (end <= s["start"])).alias("free")).alias("out"))

    def back(start: Column, x: Column) -> Column:
        s = x["s"]
        base_start = F.when(s["base"], s["start"]).otherwise(start)
        return F.struct(base_start.alias("state"), F.struct(s.alias("s"), (x["free"] & (s["base"] | (start >= s["end"]))).alias("free")).alias("out"))

    def swept(found: Column) -> Column:
        there = running(found, F.lit(0), SWEPT, forth)
        both = running(F.reverse(there), F.lit(2**31 - 1), SWEPT, back)
        return F.reverse(F.transform(F.filter(both, lambda x: x["free"]), lambda x: x["s"]))

    return bound(spans, lambda f: F.when(F.exists(f, lambda s: s["base"]) & F.exists(f, lambda s: ~s["base"]), swept(f)).otherwise(f))


def reliabilities(patterns: list[tuple[str, tuple[int, ...], int]], rounds: int = 50) -> dict[tuple[str, tuple[int, ...]], float]:
    """Probability that a candidate is personal data, for each kind and vote pattern, by expectation-maximisation.

    Votes are independent given the truth; an abstention tells nothing. The
    start trusts every labeler alike; counts are smoothed by one.
    """
    out = {}
    for kind in KINDS:
        own = [(v, n) for k, v, n in patterns if k == kind]
        if not own:
            continue
        prior = 0.5
        hit = [[0.8, 0.2] for _ in LABELERS]  # P(vote is yes | truth is yes, no)
        for _ in range(rounds):
            post = {}
            for v, _ in own:
                odds = math.log(prior / (1 - prior))
                for (yes, no), x in zip(hit, v):
                    odds += math.log(yes / no) if x > 0 else math.log((1 - yes) / (1 - no)) if x < 0 else 0
                post[v] = 1 / (1 + math.exp(-max(-30.0, min(30.0, odds))))
            total = sum(n for _, n in own)
            prior = (sum(post[v] * n for v, n in own) + 1) / (total + 2)
            for j in range(len(LABELERS)):
                for side in (0, 1):
                    weight = [(x[j], n * (post[x] if side == 0 else 1 - post[x])) for x, n in own if x[j]]
                    held = sum(w for _, w in weight)
                    hit[j][side] = (sum(w for x, w in weight if x > 0) + (1.6 if side == 0 else 0.4)) / (held + 2)
        out.update({(kind, v): p for v, p in post.items()})
    return out


def string_map(values: dict[str, float]) -> Column:
    return F.create_map(*(F.lit(x) for pair in sorted(values.items()) for x in pair)) if values else F.lit(None).cast("map<string,double>")


def trained(found: DataFrame, spans: str) -> Column:
    """The final classifier: a map from "kind feature" to log odds, with "kind" alone for the prior.

    One pass counts features by kind and votes; those counts, at most kinds x
    3^4 patterns x a few hundred feature values, tell both the patterns'
    probabilities and, weighted by these, the features' odds.
    """
    each = found.select(F.explode(spans).alias("s"))
    pairs = each.select("s.kind", "s.votes", F.explode(F.concat(F.array(F.lit("")), F.col("s.features"))).alias("feature"))
    rows = [(r["kind"], tuple(r["votes"]), r["feature"], r["count"]) for r in pairs.groupBy("kind", "votes", "feature").count().collect()]
    post = reliabilities(sorted((k, v, n) for k, v, f, n in rows if f == ""))
    sums: dict[tuple[str, str], list[float]] = {}
    for k, v, f, n in sorted(rows):
        both = sums.setdefault((k, f), [0.0, 0.0])
        both[0] += n * post[k, v]
        both[1] += n * (1 - post[k, v])
    odds = {k: math.log((yes + 1) / (no + 1)) for (k, f), (yes, no) in sums.items() if f == ""}
    for (k, f), (yes, no) in sums.items():
        if f:
            whole = sums[k, ""]
            odds[f"{k} {f}"] = math.log((yes + 1) / (whole[0] + 10)) - math.log((no + 1) / (whole[1] + 10))
    return string_map(odds)


def accepted(spans: Column, odds: Column) -> Column:
    """Base spans, and spans of further kinds that the classifier accepts, without overlaps among these."""
    def score(s: Column) -> Column:
        parts = F.transform(s["features"], lambda f: F.coalesce(F.element_at(odds, F.concat_ws(" ", s["kind"], f)), F.lit(0.0)))
        return F.aggregate(parts, F.coalesce(F.element_at(odds, s["kind"]), F.lit(0.0)), lambda a, x: a + x)

    taken = F.filter(spans, lambda s: s["base"] | (~s["kind"].isin(*BASE) & (score(s) > 0)))

    # By start, longer first: an earlier further span that reaches a later one beats it, itself beaten or not.
    def forth(end: Column, s: Column) -> Column:
        further = F.when(s["base"], end).otherwise(F.greatest(end, s["end"]))
        return F.struct(further.alias("state"), F.struct(s.alias("s"), (s["base"] | (end <= s["start"])).alias("free")).alias("out"))

    def swept(found: Column) -> Column:
        return F.transform(F.filter(running(found, F.lit(0), SWEPT, forth), lambda x: x["free"]), lambda x: x["s"])

    return bound(taken, lambda t: F.when(F.size(F.filter(t, lambda s: ~s["base"])) > 1, swept(t)).otherwise(t))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None, spans: str = "spans", settle: bool = True) -> DataFrame:
    """Columns ``keep`` of ``docs`` and ``spans`` by start: kind, start, end (code points, end exclusive), base.

    ``settle`` keeps the candidates with the columns ``keep`` between training
    and decision; without it the candidates are found twice and nothing is kept.
    """
    keep = [c for c in (docs.columns if keep is None else keep) if c.lower() != spans.lower()]
    found = docs.select(*keep, only_candidates(candidates(F.col(text))).alias(spans))
    found = settled(found) if settle else found
    odds = trained(found, spans)
    slim = F.transform(accepted(F.col(spans), odds), lambda s: F.struct(s["kind"], s["start"], s["end"], s["base"]))
    return found.withColumn(spans, slim)


def of_kind(spans: Column, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def listed(spans: Column, kinds: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of the spans, by kind as listed and then start, joined by commas."""
    parts = [F.array_sort(of_kind(spans, k), lambda a, b: F.when(a["start"] < b["start"], -1).when(a["start"] > b["start"], 1).otherwise(0)) for k in kinds]
    return F.array_join(F.transform(F.concat(*parts), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


#: Code points of the pieces that a text is cut into, so that a place in it is found without counting from its start.
PIECE = 2048


def masked(text: Column, spans: Column) -> Column:
    """``text`` with each span replaced by its kind's mask; overlapping spans share the first one's.

    Work in proportion to the text and the spans.
    """
    keyed = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), (-s["end"]).alias("back"), s["kind"].alias("kind"), s["end"].alias("end")))
    mask = F.create_map(*(F.lit(x) for pair in MASKS.items() for x in pair))

    def part(pieces: Column, a: Column, b: Column) -> Column:
        """Code points ``a`` to ``b`` of the text; nothing if b <= a."""
        first, last = F.floor(a / PIECE).cast("int"), F.floor((b - 1) / PIECE).cast("int")
        one = F.substring(F.try_element_at(pieces, first + 1), a % PIECE + 1, b - a)
        head = F.substring(F.try_element_at(pieces, first + 1), a % PIECE + 1, F.lit(PIECE))
        inner = F.array_join(F.slice(pieces, first + 2, F.greatest(last - first - 1, F.lit(0))), "")
        end = F.substring(F.try_element_at(pieces, last + 1), F.lit(1), (b - 1) % PIECE + 1)
        return F.when(b <= a, "").when(first == last, one).otherwise(F.concat(head, inner, end))

    def built(pieces: Column) -> Column:
        def step(at: Column, s: Column) -> Column:
            new = F.concat(part(pieces, at, s["start"]), F.element_at(mask, s["kind"]))
            return F.struct(F.greatest(at, s["end"]).alias("state"), F.when(s["start"] < at, "").otherwise(new).alias("out"))

        rest = part(pieces, F.array_max(F.transform(spans, lambda s: s["end"])), F.length(text))
        return F.concat(F.array_join(running(F.array_sort(keyed), F.lit(0), "string", step), ""), rest)

    cut = F.regexp_extract_all(text, F.lit("(?s).{1,%d}" % PIECE), F.lit(0))
    return F.when(F.size(spans) > 0, bound(cut, built)).otherwise(text)
