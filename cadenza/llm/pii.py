"""PII (operator 3): weak supervision over candidate spans, DataFrame functions only.

Candidates are the base spans (fixed patterns and checks) and looser finds: formatted numbers
next to other digits, spelled-out addresses, access keys. Three labelers vote +1, 0 or -1 on
each candidate: the shape of its text (regex and checksum), a gazetteer (country codes, card
issuers, top-level domains, key prefixes, public networks), and the words before it. Spark
counts the vote patterns of the whole corpus; expectation-maximisation on that bounded table
estimates how reliable each labeler is, without any labelled span. Its posteriors are the soft
labels of the final span classifier, naive Bayes over the votes and the span's shape, which
decides on the looser finds. Base spans always stay.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadenza.llm.common import written

KINDS = ["email", "ip", "card", "phone", "secret"]

# Base patterns, written without backtracking. A run of a greedy class is matched whole, from
# its start, or from the end of the match before it.
BASE = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?=(?:[0-9][\x20-]?){15}[0-9])[0-9]++(?:[\x20-][0-9]++)*+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
# Looser finds
NEAR = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]++(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:(?:\.|\[\.\])[0-9]{1,3}){3}(?![0-9])|(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])(?:(?:[0-9]{4}[ -]?){3}[0-9]{4}|3[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9])",
    "phone": r"(?:\+[0-9]{1,3}[ -]?)?(?:\([0-9]{3}\) ?|(?<![0-9])[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])",
    "secret": r"\b(?:AKIA|ASIA)[0-9A-Z]{16}\b|\bghp_[0-9A-Za-z]{36}\b|\x22(?=[A-Za-z]*[0-9])[0-9A-Za-z_/+-]{16,128}\x22",
}
# Gazetteers: starts of the digits (card, phone), ends (email), starts of the text (secret)
ISSUERS = r"^(?:4|5[1-5]|2[2-7]|3[0456789]|6011|62|64|65)"
COUNTRY_CODES = r"^\+(?:1|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|7|8[1246]|9[0-58])"
DOMAINS = r"(?i)(?:com|org|net|edu|gov|info|io|de|fr|es|uk|eu|it|nl|ch|at)$"
KEY_PREFIXES = r"^\x22?(?:AKIA|ASIA|ghp_|sk_|xox)"
PRIVATE_NETS = r"^(?:0|127|10|255|22[4-9]|23[0-9])\b|^192\.168\.|^169\.254\."
# Words before a span that speak for a kind, and words that speak against any
CONTEXT = {
    "email": r"(?i)\b(?:e-?mail|mail|contact|contacto|correo|courriel|adresse|kontakt|write to)\W*$",
    "ip": r"(?i)\b(?:ip|address|host|server|adresse|from|servidor|serveur)\W*$",
    "card": r"(?i)\b(?:card|visa|mastercard|amex|tarjeta|carte|karte|credit|cc)\W*(?:number|no|nr)?\W*$",
    "phone": r"(?i)\b(?:phone|tel|telefon|call|mobile|cell|fax|telefono|t[eé]l[eé]phone|llame|appelez|ruf)\W*$",
    "secret": r"(?i)\b(?:token|key|secret|password|passwd|pwd|apikey|api_key)\W*$",
}
AGAINST = r"(?i)\b(?:version|isbn|issn|order|invoice|section|chapter|figure|doi|ticket)\W*(?:no|nr)?\W*$"
BEFORE = 32
#: A looser find is added from this probability on, with a vote for it and none against.
ACCEPT = 0.9


def _matches(kind: int, text: Column, pattern: str) -> Column:
    """Array of (kind, start, end, found, before): all matches, positions in code points.

    The text between matches, split by the same pattern, gives the positions.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    empty = F.lit([]).cast("array<struct<kind:int,start:bigint,end:bigint,found:string,before:string>>")

    def step(acc, x):
        start = acc["at"] + F.length(x["gap"])
        end = start + F.length(x["hit"])
        before = F.substring(text, F.greatest(start - BEFORE, F.lit(0)).cast("int") + 1,
                             F.least(start, F.lit(BEFORE)).cast("int"))
        one = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"),
                       x["hit"].alias("found"), before.alias("before"))
        return F.struct(end.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

    pieces = F.zip_with(found, F.slice(between, 1, F.size(found)), lambda h, g: F.struct(g.alias("gap"), h.alias("hit")))
    all_ = F.aggregate(pieces, F.struct(F.lit(0).cast("bigint").alias("at"), empty.alias("out")), step, lambda a: a["out"])
    return F.when(F.size(found) > 0, all_).otherwise(empty)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Luhn's checksum of a digit string is 0."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(
        i % 2 == 1, (c.cast("int") * 2) % 10 + F.floor(c.cast("int") * 2 / 10).cast("int")).otherwise(c.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(text: Column) -> Column:
    """All four parts are at most 255 (leading zeros aside)."""
    return F.forall(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+", "").rlike(
        "^(?:|[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])$"))


def _valid(kind: str, found: Column) -> Column:
    if kind == "ip":
        return _octets(found)
    if kind == "card":
        return F.length(_digits(found)).between(16, 19) & luhn(_digits(found))
    if kind == "phone":
        return F.length(_digits(found)).between(8, 15)
    return F.lit(True)


def _votes(s: Column) -> list[Column]:
    """The three labelers' votes on a span: shape, gazetteer, context."""
    found, digits = s["found"], _digits(s["found"])
    kind = {k: s["kind"] == i for i, k in enumerate(KINDS)}

    def vote(yes: Column, no: Column) -> Column:
        return F.when(yes, 1).when(no, -1).otherwise(0)

    v4 = found.rlike(r"^[0-9.\[\]]+$")
    octets = _octets(F.regexp_replace(found, r"[\[\]]", ""))
    shape = (F.when(kind["email"], vote(found.rlike(r"^[^ @]+@[^ @]+$"), F.lit(False)))
             .when(kind["ip"], vote(~v4 | octets, v4 & ~octets))
             .when(kind["card"], vote(luhn(digits), ~luhn(digits)))
             .when(kind["phone"], vote(found.startswith("+") & F.length(digits).between(8, 15), F.length(digits) > 15))
             .otherwise(vote(found.rlike(r"^(?:AKIA|ASIA)[0-9A-Z]{16}$|^ghp_"), F.lit(False))))
    gazetteer = (F.when(kind["email"], vote(found.rlike(DOMAINS), F.lit(False)))
                 .when(kind["ip"], vote(~found.rlike(PRIVATE_NETS), F.lit(False)))
                 .when(kind["card"], vote(digits.rlike(ISSUERS), digits.rlike("^(?:0|1|9)")))
                 .when(kind["phone"], vote(found.rlike(COUNTRY_CODES), digits.rlike("^0?[01]{3}")))
                 .otherwise(vote(found.rlike(KEY_PREFIXES), F.lit(False))))
    said = F.lit(False)
    for k, pattern in CONTEXT.items():
        said = said | (kind[k] & s["before"].rlike(pattern))
    return [shape.alias("shape"), gazetteer.alias("gazetteer"), vote(said, s["before"].rlike(AGAINST)).alias("context")]


def _form(s: Column) -> Column:
    """The classifier's features of a span's text: length, digits and separators, in classes."""
    n = F.least(F.floor(F.length(s["found"]) / 4), F.lit(12)).cast("int")
    digits = F.least(F.floor(F.length(_digits(s["found"])) / 4), F.lit(8)).cast("int")
    apart = F.least(F.length(F.regexp_replace(s["found"], "[0-9A-Za-z]", "")), F.lit(6)).cast("int")
    return F.struct(n.alias("length"), digits.alias("digits"), apart.alias("apart"))


def find_spans(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, near)``: valid base spans, and voted candidates (base ones flagged).

    Map-only. Texts without a digit, ``@`` or a spelled-out at-sign are passed over quickly.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text.alias("text"))
    busy = F.col("text").rlike("[0-9@]") | F.contains("text", F.lit("(at)")) | F.contains("text", F.lit("[at]"))
    rows = rows.select("doc_id", F.when(busy, F.col("text")).otherwise("").alias("text"))

    def valid(kind: str) -> Column:
        return F.filter(_matches(KINDS.index(kind), F.col("text"), BASE[kind]), lambda s: _valid(kind, s["found"]))

    base = F.concat(*[valid(k) for k in BASE])
    near = F.concat(*[_matches(KINDS.index(k), F.col("text"), p) for k, p in NEAR.items()])
    rows = rows.select("doc_id", base.alias("base"), near.alias("near"))
    apart = F.filter("near", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))

    def voted(spans, is_base: bool) -> Column:
        return F.transform(spans, lambda s: F.struct(
            s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), *_votes(s),
            _form(s).alias("form"), F.lit(is_base).alias("is_base")))

    short = F.transform("base", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return rows.select("doc_id", short.alias("base"), F.concat(voted("base", True), voted(apart, False)).alias("near"))


def em_reliabilities(patterns: dict[tuple, float], rounds: int = 60) -> dict[tuple, float]:
    """Posterior of every vote pattern ``(kind, shape, gazetteer, context)``, by EM.

    Per kind the labelers vote independently given whether the span is real; smoothing counts
    say beforehand that a labeler is right more often than not.
    """
    out = {}
    for kind in {p[0] for p in patterns}:
        own = {p[1:]: n for p, n in patterns.items() if p[0] == kind}
        post = {p: 1 / (1 + math.exp(-1.5 * sum(p))) for p in own}
        for _ in range(rounds):
            prior = [1.0, 1.0]
            table = [[{v: 1.0 + (2.0 if v == (1 if y else -1) else 0.0) for v in (-1, 0, 1)} for _ in range(3)] for y in (0, 1)]
            for p, n in own.items():
                for y, w in ((1, n * post[p]), (0, n * (1 - post[p]))):
                    prior[y] += w
                    for labeler, v in enumerate(p):
                        table[y][labeler][v] += w
            for p in own:
                like = [math.log(prior[y]) + sum(math.log(table[y][i][v] / sum(table[y][i].values()))
                                                 for i, v in enumerate(p)) for y in (0, 1)]
                post[p] = 1 / (1 + math.exp(max(-700, min(700, like[0] - like[1]))))
        out.update({(kind, *p): q for p, q in post.items()})
    return out


def accepted(counts: list[tuple]) -> set[tuple]:
    """Rows ``(kind, shape, gazetteer, context, length, digits, apart, n)`` → the accepted ones.

    The span classifier: naive Bayes over the form, per kind, fitted to the posteriors of the
    votes, together with those posteriors.
    """
    votes: dict[tuple, float] = defaultdict(float)
    for *key, n in counts:
        votes[tuple(key[:4])] += n
    post = em_reliabilities(votes)
    weight: dict[tuple, list[float]] = defaultdict(lambda: [1.0, 1.0])
    total: dict[int, list[float]] = defaultdict(lambda: [1.0, 1.0])
    for kind, a, b, c, *form, n in counts:
        q = post[kind, a, b, c]
        for y, w in ((0, n * (1 - q)), (1, n * q)):
            total[kind][y] += w
            for i, v in enumerate(form):
                weight[kind, i, v][y] += w
    out = set()
    for kind, a, b, c, *form, _ in counts:
        q = min(max(post[kind, a, b, c], 1e-9), 1 - 1e-9)
        logit = math.log(q / (1 - q))
        for i, v in enumerate(form):
            no, yes = weight[kind, i, v]
            logit += math.log(yes / (total[kind][1] + 1)) - math.log(no / (total[kind][0] + 1))
        if logit >= math.log(ACCEPT / (1 - ACCEPT)) and max(a, b, c) > 0 and min(a, b, c) >= 0:
            out.add((kind, a, b, c, *form))
    return out


def _key(s: Column) -> Column:
    return F.concat_ws(":", s["kind"], s["shape"], s["gazetteer"], s["context"], s["form"]["length"], s["form"]["digits"],
                       s["form"]["apart"])


def pii_table(docs: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans (``kind:start:end``, code points).

    Null text is empty and has none. Rows may repeat, ids be null; an empty table gives none.
    """
    found = written(find_spans(docs), "pii")
    span = found.select(F.explode("near").alias("s"))
    counts = span.groupBy("s.kind", "s.shape", "s.gazetteer", "s.context", "s.form.length", "s.form.digits",
                          "s.form.apart").agg(F.count(F.lit(1)).alias("n")).collect()    # a few thousand rows at most
    keys = sorted(":".join(map(str, k)) for k in accepted([tuple(r) for r in counts]))
    good = F.split(F.lit(",".join(keys)), ",") if keys else F.array().cast("array<string>")
    added = F.transform(F.filter("near", lambda s: ~s["is_base"] & F.array_contains(good, _key(s))),
                        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    names = F.split(F.lit(",".join(KINDS)), ",")

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
            ":", F.get(names, s["kind"]), s["start"], s["end"])), ",")

    base = F.col("base")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == KINDS.index(kind))).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in BASE], F.sha2(text(base), 256).alias("base_sha256"), text(F.concat(base, added)).alias("spans"),
        F.size(added).cast("bigint").alias("n_added"))
