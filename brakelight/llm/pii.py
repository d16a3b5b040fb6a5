"""Personal data: patterns, gazetteers and context vote; EM weighs the voters and trains a span classifier."""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import located_if, scratch_table, span_list, text_or_empty

KINDS = ["email", "ip", "card", "phone", "local_phone", "national_id", "email_at"]
BASE = 4
#: outer groups are possessive: nothing follows them, and a greedy group would recurse once per repetition
#: a match begins at the start of its run, or right after the match before it; the other starts cannot match
EMAIL = r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)"
#: a maximal run with fewer than 13 digits fails its check from every start, so it is not matched at all
CARD = r"(?<![0-9])[0-9](?:[\x20-]?[0-9]){12,}+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
LOCAL_PHONE = r"(?<![0-9+A-Za-z])\(?[0-9]{3}\)?[ .-][0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])"
NATIONAL_ID = r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])"
EMAIL_AT = (r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+ ?[\[(] ?at ?[\])] ?[A-Za-z0-9-]{1,63}+"
            r"(?: ?(?:[\[(] ?dot ?[\])]|\.) ?[A-Za-z0-9-]{1,63}+)++")

#: fixed values: gazetteers
TOP_DOMAINS = ["com", "org", "net", "edu", "gov", "info", "io", "de", "fr", "es", "it", "uk", "nl", "eu", "ch", "at"]
DIAL_CODES = ["1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46",
              "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58", "60", "61", "62", "63", "64", "65",
              "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"]
CARD_PREFIX = r"^(?:4|5[1-5]|2[2-7]|3[47]|6011|65)"
#: fixed values: context words per kind, looked for in the characters before a span
CONTEXT = {
    "email": "mail|contact|write|from|to:|correo|courriel|kontakt",
    "ip": r"\bip\b|address|host|server|client|login|adresse|direcci",
    "card": "card|visa|master|amex|credit|debit|pay|karte|carte|tarjeta",
    "phone": r"phone|\btel|call|mobile|cell|fax|telefon|t[ée]l[ée]phone",
    "local_phone": r"phone|\btel|call|mobile|cell|fax|telefon",
    "national_id": "ssn|social|security|tax|identity|passport",
    "email_at": "mail|contact|write|correo|courriel|kontakt",
}
AGAINST = r"version|\bv\.?\s?$|release|build|order|invoice|isbn|page|section|article no|ref\b|figure|serial"
VOTERS = ["pattern", "check", "gazetteer", "context"]
WINDOW = 32
#: characters of the pieces in which a text is looked up; a lookup in the whole text would walk it from its start
CHUNK = 1024


def any_of(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def _luhn(digits: Column) -> Column:
    """Luhn sum of a digit string, from its last digit on, is a multiple of ten."""
    d = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    terms = F.transform(d, lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        F.when(c.cast("int") * 2 > 9, c.cast("int") * 2 - 9).otherwise(c.cast("int") * 2)))
    return F.aggregate(terms, F.lit(0), lambda a, x: a + x) % 10 == 0


_OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _valid(kind: int, m: Column) -> Column:
    """Whether a match of a kind passes the kind's fixed check (true for kinds without one)."""
    n = F.char_length(_digits(m))
    return {1: m.rlike(_OCTETS), 2: n.between(13, 19) & _luhn(_digits(m)), 3: n.between(9, 15)}.get(kind, F.lit(True))


def _checked(kind: int, m: Column) -> Column:
    """Vote of the format check: 1, 0 or -1 (abstains)."""
    d = _digits(m)
    if kind == 0:
        return F.when(m.rlike(r"\.[A-Za-z]{2,24}$") & ~m.rlike(r"\.\.|^\."), 1).otherwise(0)
    if kind == 1:
        return F.when(~m.rlike(_OCTETS), 0).when(m.rlike(r"^(?:[0-9]\.){3}[0-9]$"), -1).otherwise(1)
    if kind == 2:
        return F.when(F.char_length(d).between(13, 19) & _luhn(d), 1).otherwise(0)
    if kind == 3:
        return F.when(F.char_length(d).between(9, 15), 1).otherwise(0)
    if kind == 4:
        return F.when(d.rlike("^[2-9][0-9]{2}[2-9]"), 1).otherwise(0)
    if kind == 5:
        return F.when(d.rlike("^(?:000|666|9)") | d.rlike("^.{3}00") | d.rlike("0000$"), 0).otherwise(1)
    return F.when(m.rlike("[A-Za-z]{2,24}$"), 1).otherwise(0)


def _listed(kind: int, m: Column) -> Column:
    """Vote of the gazetteer: 1, 0 or -1 (abstains)."""
    if kind in (0, 6):
        return F.when(F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1)).isin(TOP_DOMAINS), 1).otherwise(-1)
    if kind == 1:
        return F.when(m.rlike(r"^(?:0|255)\."), 0).otherwise(-1)
    if kind == 2:
        return F.when(_digits(m).rlike(CARD_PREFIX), 1).otherwise(0)
    if kind == 3:
        d = _digits(m)
        return F.when(F.substring(d, 1, 1).isin(DIAL_CODES) | F.substring(d, 1, 2).isin(DIAL_CODES), 1).otherwise(-1)
    return F.lit(-1)


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, cand (array of spans with votes and features). One pass, no shuffle.

    A candidate has k (kind), s and e (code points, end exclusive), base (a base match that passes its check),
    key (kind and votes) and f (features for the classifier). Matches that fail their check stay candidates:
    they are the evidence against.
    """
    t = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    tests = [t.contains("@"), t.rlike(r"[0-9]\.[0-9]"), t.rlike(CARD), t.contains("+"), t.rlike("[0-9][.-][0-9]{4}"),
             t.rlike("[0-9]-[0-9]{2}-"), t.rlike(r"[\[(] ?at ?[\])]")]
    pats = [EMAIL, IP, CARD, PHONE, LOCAL_PHONE, NATIONAL_ID, EMAIL_AT]
    found = rows.select("id", *[located_if(test, t, p).alias(f"m{k}") for k, (test, p) in enumerate(zip(tests, pats))],
                        F.when(any_of(tests), F.regexp_extract_all("text", F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0))).alias("chunks"))

    def preceding(s: Column) -> Column:
        """The WINDOW characters before position ``s``, from the chunk of the text that holds them and the one before."""
        at = (s / CHUNK).cast("int")
        two = F.concat(F.coalesce(F.get("chunks", at - 1), F.lit("")), F.coalesce(F.get("chunks", at), F.lit("")))
        end = s - F.greatest(at - 1, F.lit(0)) * CHUNK
        return F.substring(two, F.greatest(end - WINDOW + 1, F.lit(1)), F.least(end, F.lit(WINDOW)))

    def voted(k: int) -> Column:
        def one(x):
            before = F.lower(preceding(x["s"]))
            context = F.when(before.rlike(CONTEXT[KINDS[k]]), 1).when(before.rlike(AGAINST), 0).otherwise(-1)
            return F.struct(
                F.lit(k).alias("k"), x["s"].alias("s"), x["e"].alias("e"), x["m"].alias("m"),
                _valid(k, x["m"]).alias("ok"), _checked(k, x["m"]).alias("check"),
                _listed(k, x["m"]).alias("listed"), context.alias("context"),
                F.substring(before, -1, 1).alias("left"))
        return F.transform(f"m{k}", one)

    judged = found.select("id", *[voted(k).alias(f"m{k}") for k in range(len(KINDS))])

    def flat(x):
        d = F.char_length(_digits(x["m"]))
        shape = F.substring(F.regexp_replace(F.regexp_replace(F.regexp_replace(
            x["m"], "[A-Za-z]+", "a"), "[0-9]+", "0"), " +", "_"), 1, 12)
        key = F.concat_ws(",", x["k"].cast("string"), F.when(x["ok"], "1").otherwise("0"),
                          x["check"].cast("string"), x["listed"].cast("string"), x["context"].cast("string"))
        left = (F.when(x["left"] == "", "start").when(x["left"].rlike(r"[\s(<\[\"':;,]"), "open")
                .when(x["left"].rlike("[0-9A-Za-z]"), "word").otherwise("mark"))
        f = F.array(key, F.concat(F.lit("left="), x["k"].cast("string"), left),
                    F.concat(F.lit("digits="), x["k"].cast("string"), F.lit(":"), F.least(d, F.lit(20)).cast("string")),
                    F.concat(F.lit("marks="), x["k"].cast("string"), F.lit(":"),
                             F.least(F.char_length(shape), F.lit(12)).cast("string")))
        return F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"),
                        (x["ok"] & (x["k"] < BASE)).alias("base"), f.alias("f"))

    every = F.concat(*[F.col(f"m{k}") for k in range(len(KINDS))])
    return judged.select("id", F.transform(every, flat).alias("cand"))


def fit_voters(patterns: list[tuple[str, int]], rounds: int = 60) -> dict[str, float]:
    """Probability of personal data per vote pattern by expectation maximisation.

    ``patterns`` are (kind and votes, how many candidates), at most one per kind and combination of votes (7 * 2 *
    27 keys whatever the corpus). Latent truth per candidate; a prior per kind; per voter the chance of each of
    its three answers given the truth. Starts from the share of votes in favour.
    """
    rows = [(k.split(","), n) for k, n in sorted(patterns)]
    post = []
    for v, _ in rows:
        votes = [int(x) for x in v[1:] if x != "-1"]
        post.append(min(0.95, max(0.05, sum(votes) / len(votes))) if votes else 0.5)
    for _ in range(rounds):
        prior, total = defaultdict(lambda: 1.0), defaultdict(lambda: 2.0)
        seen = [defaultdict(lambda: [0.5, 0.5]) for _ in VOTERS]
        sums = [0.0, 0.0]
        for (v, n), p in zip(rows, post):
            prior[v[0]] += n * p
            total[v[0]] += n
            sums[1] += n * p
            sums[0] += n * (1 - p)
            for j, x in enumerate(v[1:]):
                seen[j][x][1] += n * p
                seen[j][x][0] += n * (1 - p)
        new = []
        for v, _ in rows:
            pi = prior[v[0]] / total[v[0]]
            lo = math.log(pi) - math.log1p(-pi)
            for j, x in enumerate(v[1:]):
                lo += math.log(seen[j][x][1] / (sums[1] + 1.5)) - math.log(seen[j][x][0] / (sums[0] + 1.5))
            new.append(1 / (1 + math.exp(-max(-30.0, min(30.0, lo)))))
        done = max((abs(a - b) for a, b in zip(post, new)), default=0.0) < 1e-9
        post = new
        if done:
            break
    return {",".join(v): p for (v, _), p in zip(rows, post)}


def _lookup(table: dict[str, float], key: Column, default: float) -> Column:
    if not table:
        return F.lit(default)
    flat = [F.lit(x) for kv in sorted(table.items()) for x in kv]
    return F.coalesce(F.element_at(F.create_map(*flat), key), F.lit(default))


def find_pii(docs: DataFrame, threshold: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_email, n_ip, n_card, n_phone, base (spans), spans (base and added spans).

    Candidates of seven kinds get votes of four labelers (pattern with its check, format check, gazetteer,
    context words). ``fit_voters`` turns the counts of vote patterns into probabilities; these label every
    candidate softly, and a naive Bayes classifier over the votes, the character before, the digit count and the
    shape of a span is trained on all of them. Base matches always stay; other candidates are added when they
    passed their pattern, the classifier gives ``threshold`` or more, and they touch no base span.

    Only counts travel: vote patterns and feature values are aggregated per task and their tables are bounded by
    the kinds and feature domains. Null text counts as empty; repeated rows give repeated results; an empty
    table gives an empty result; further columns are ignored. Without candidates nothing is added.
    """
    cand = scratch_table(candidates(docs, id_col, text_col), "pii-candidates")
    each = cand.filter(F.size("cand") > 0).select(F.explode("cand").alias("x")).select(
        "x.k", "x.base", "x.f", F.get("x.f", F.lit(0)).alias("key"))
    post = fit_voters([(r["key"], r["count"]) for r in each.groupBy("key").count().collect()])
    p = _lookup(post, F.col("key"), 0.5)
    stats = (each.select("f", p.alias("p")).select(F.explode("f").alias("f"), "p")
             .groupBy("f").agg(F.sum("p").alias("yes"), F.sum(1 - F.col("p")).alias("no")))
    rows = sorted((r["f"], r["yes"], r["no"]) for r in stats.collect())
    yes = sum(y for f, y, _ in rows if "=" not in f)
    no = sum(n for f, _, n in rows if "=" not in f)
    weight = {f: round(math.log((y + 0.5) / (yes + 1)) - math.log((n + 0.5) / (no + 1)), 9) for f, y, n in rows}
    prior = round(math.log((yes + 1) / (no + 1)), 9)

    def score(x):
        return F.aggregate(F.transform(x["f"], lambda f: _lookup(weight, f, 0.0)), F.lit(prior), lambda a, w: a + w)

    limit = math.log(threshold / (1 - threshold))
    picked = cand.select(F.col("id"), "cand", F.transform(F.filter("cand", lambda x: x["base"]), _span).alias("base"))
    picked = picked.select("id", "base", F.transform(F.filter("cand", lambda x: (x["k"] >= BASE) & (score(x) >= limit)),
                                                     _span).alias("extra"))
    extra = F.filter("extra", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"])))
    count = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long")
    return picked.select(F.col("id").alias(id_col), *[count(k).alias(f"n_{KINDS[k]}") for k in range(BASE)],
                         F.array_sort("base").alias("base"), F.array_sort(F.concat("base", extra)).alias("spans"))


def _span(x: Column) -> Column:
    return F.struct(x["k"].alias("k"), x["s"].alias("s"), x["e"].alias("e"))


def span_text(spans: Column) -> Column:
    return span_list(spans, KINDS)
