"""Secret scans: fixed patterns, and windows of high Shannon entropy over candidate strings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import in_blocks, located_if, span_list, text_or_empty

KINDS = ["assign", "access", "hex", "entropy"]
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]++"
#: a shorter run fails from every start within it, so asking for 24 at once finds the same spans
HEX = r"[0-9a-f]{24,}+"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}+"

#: fixed values: strings that look random but are known not to be secrets
ALLOWED = [r"(?i)example|sample|dummy|placeholder|changeme|xxxx",
           r"(?i)0123456789|abcdefghij|qwertyuiop",
           r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
           r"^[0-9](?:[-_/=+]?[0-9])*+[-_/=+]?$", r"(.)\1{7}"]
#: classes of characters with fewer symbols than base64: letters and digits of one case, with their number of symbols
HEX_RUN, CLASSES = r"[0-9a-fA-F]", [(r"[A-Z2-7]", 32), (r"[a-z2-7]", 32), (r"[a-z0-9]", 36), (r"[A-Z0-9]", 36)]
ALPHABET = "0123456789abcdefABCDEFghijklmnopqrstuvwxyzGHIJKLMNOPQRSTUVWXYZ+/_=-"


def entropy_moments(symbols: int, width: int) -> tuple[float, float]:
    """Mean and standard deviation of the entropy of ``width`` uniformly random characters out of ``symbols``."""
    f = [c * math.log2(c) if c else 0.0 for c in range(width + 1)]
    p = 1 / symbols
    one = [math.comb(width, c) * p ** c * (1 - p) ** (width - c) for c in range(width + 1)]
    mean = sum(x * y for x, y in zip(one, f))
    own = sum(x * y * y for x, y in zip(one, f)) - mean * mean
    two = sum(math.comb(width, a) * math.comb(width - a, c) * p ** (a + c) * (1 - 2 * p) ** (width - a - c) * f[a] * f[c]
              for a in range(width + 1) for c in range(width + 1 - a)) - mean * mean
    return math.log2(width) - symbols * mean / width, max(symbols * (own + (symbols - 1) * two), 0) ** 0.5 / width


def class_bits(symbols: int, width: int, mixed_bits: float) -> float:
    """The limit that is as many standard deviations below the mean of its class as ``mixed_bits`` is for base64."""
    (mean, sd), (mean64, sd64) = entropy_moments(symbols, width), entropy_moments(64, width)
    return mean - (mean64 - mixed_bits) * sd / sd64


#: positions that one fold judges; it copies the list it grows, so it is kept short
BLOCK = 256


def window_entropy(codes: Column, width: int) -> Column:
    """Entropy in bits of every window of ``width`` consecutive ``codes`` (1-based letters of ALPHABET), by its start.

    A fold carries the count of every letter and the sum of c*log2(c); a step removes the letter that leaves
    the window and adds the one that enters, so only their two counts change. Each block of positions has a fold
    of its own, which reads the ``width`` letters before, so the work grows with the length of the run.
    """
    f = F.array(*[F.lit(float(c * math.log2(c)) if c else 0.0) for c in range(width + 1)])
    size = len(ALPHABET) + 1
    start = F.struct(F.array_repeat(F.lit(0), size).alias("c"), F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("h"))

    def put(counts, at, value):
        return F.concat(F.slice(counts, F.lit(1), at), F.array(value), F.slice(counts, at + 2, F.lit(size)))

    def fold(_, at):
        def own(i):
            return F.element_at(codes, at - 1 + i)

        def step(acc, i):
            new, old = own(i), F.when(i > width, own(F.greatest(i - width, F.lit(1)))).otherwise(F.lit(0))
            n_old = F.get(acc["c"], old)
            left = F.when(old > 0, F.get(f, n_old - 1) - F.get(f, n_old)).otherwise(F.lit(0.0))
            less = F.when(old > 0, put(acc["c"], old, n_old - 1)).otherwise(acc["c"])
            n_new = F.get(acc["c"], new) - F.when(old == new, F.lit(1)).otherwise(F.lit(0))
            total = acc["sum"] + left + F.get(f, n_new + 1) - F.get(f, n_new)
            h = F.when(i >= width, F.concat(acc["h"], F.array(F.lit(math.log2(width)) - total / width))).otherwise(acc["h"])
            return F.struct(put(less, new, n_new + 1).alias("c"), total.alias("sum"), h.alias("h"))

        last = F.least(F.lit(BLOCK + width - 1), F.size(codes) - at + 1)
        return F.aggregate(F.sequence(F.lit(1), last), start, step, lambda acc: acc["h"])

    starts = F.slice(codes, F.lit(1), F.greatest(F.size(codes) - width + 1, F.lit(0)))
    return F.flatten(in_blocks(starts, F.lit(BLOCK), fold))


def scan_secrets(docs: DataFrame, width: int = 20, hex_bits: float = 3.0, mixed_bits: float = 3.85,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, base (array of spans), spans (array of spans).

    A span is a struct (s, k, e): code-point start, index into KINDS, exclusive end. Base spans are the leftmost,
    non-overlapping matches of the fixed patterns that pass their length checks. Candidates for entropy are runs
    of 20 or more characters of the base64 and URL alphabets that hold a digit and a letter. A window is judged by
    the class of the run that holds it, a run with a digit and a letter: hex digits by ``hex_bits``, base32 and
    letters of one case with digits by ``class_bits`` of their alphabets, any other window by ``mixed_bits``. The
    span runs from the start of the first to the end of the last window above its limit. Windows that overlap a
    match of the allow-list in the candidate do not count, and spans that touch a base span are not added.

    Null text counts as empty; repeated rows give repeated results; an empty table gives an empty result; further
    columns are ignored. The scan is one projection over whole texts, without a shuffle.
    """
    t = F.col("text")
    rows = docs.select(F.col(id_col).alias("id"), text_or_empty(text_col).alias("text"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def tagged(found: Column, kind: int, ok) -> Column:
        return F.transform(F.filter(found, ok), lambda x: F.struct(x["s"].alias("s"), F.lit(kind).alias("k"),
                                                                   x["e"].alias("e")))

    limits = [(HEX_RUN, hex_bits), *[(c, class_bits(n, width, mixed_bits)) for c, n in CLASSES]]

    def runs(m: Column) -> Column:
        """Runs (s, e, bits) of a class in a candidate."""
        found = []
        for chars, bits in limits:
            p = f"{chars}{{{width},}}+"
            ok = lambda r: r["m"].rlike("[0-9]") & r["m"].rlike("[A-Za-z]")
            of_class = (lambda bits: lambda r: F.struct(r["s"].alias("s"), r["e"].alias("e"), F.lit(bits).alias("bits")))(bits)
            found.append(F.transform(F.filter(located_if(m.rlike(p), m, p), ok), of_class))
        return F.concat(*found)

    def passing(x: Column) -> Column:
        """Starts of the windows above their limit (a class asks for less than ``mixed_bits``) that touch no allowed match."""
        h = x["h"]
        places = F.sequence(F.lit(0), F.size(h) - 1)
        above = F.filter(F.transform(h, lambda b, i: F.when(b >= mixed_bits, i)), lambda i: i.isNotNull())
        of_class = F.transform(x["runs"], lambda r: F.filter(
            F.sequence(r["s"], r["e"] - width), lambda i: F.get(h, i) >= r["bits"]))
        touched = F.transform(x["off"], lambda a: F.sequence(a["s"] - width + 1, a["e"] - 1))
        return F.array_intersect(F.array_except(F.array_union(above, F.flatten(of_class)), F.flatten(touched)), places)

    def allowed(m: Column) -> Column:
        """Matches (s, e) of the allow-list in a candidate."""
        return F.concat(*[F.transform(located_if(m.rlike(p), m, p), lambda a: F.struct(a["s"].alias("s"), a["e"].alias("e")))
                          for p in ALLOWED])

    wanted = (lambda m: m.rlike("[0-9]") & m.rlike("[A-Za-z]"))
    scanned = rows.select(
        "id",
        tagged(located_if(t.rlike(ASSIGN), t, ASSIGN), 0,
               lambda x: F.char_length(F.regexp_extract(x["m"], ASSIGN, 1)) >= 6).alias("a"),
        tagged(located_if(t.contains("AKIA"), t, ACCESS), 1, lambda x: F.char_length(x["m"]) >= 20).alias("b"),
        tagged(located_if(t.rlike(HEX), t, HEX), 2, lambda x: F.lit(True)).alias("c"),
        F.transform(F.filter(located_if(t.rlike(CANDIDATE), t, CANDIDATE), lambda x: wanted(x["m"])),
                    lambda x: F.struct(
                        x["s"].alias("s"),
                        runs(x["m"]).alias("runs"), allowed(x["m"]).alias("off"),
                        F.transform(F.filter(F.split(x["m"], ""), lambda ch: ch != ""),
                                    lambda ch: F.instr(F.lit(ALPHABET), ch)).alias("codes"))).alias("cand"))
    judged = scanned.select(
        "id", "a", "b", "c",
        F.transform("cand", lambda x: F.struct(
            x["s"].alias("s"), x["runs"].alias("runs"), x["off"].alias("off"), window_entropy(x["codes"], width).alias("h"))).alias("cand"))
    high = judged.select("id", "a", "b", "c", F.transform("cand", lambda x: F.struct(
        x["s"].alias("s"), passing(x).alias("at"))).alias("cand"))
    found = high.select(
        "id", F.size("a").cast("long").alias("n_assign"), F.size("b").cast("long").alias("n_access"),
        F.size("c").cast("long").alias("n_hex"), F.array_sort(F.concat("a", "b", "c")).alias("base"),
        F.transform(F.filter("cand", lambda x: F.size(x["at"]) > 0), lambda x: F.struct(
            (x["s"] + F.array_min(x["at"])).cast("int").alias("s"), F.lit(3).alias("k"),
            (x["s"] + F.array_max(x["at"]) + width).cast("int").alias("e"))).alias("extra"))
    out = found.select(
        F.col("id").alias(id_col), "n_assign", "n_access", "n_hex", "base",
        F.when(F.size("extra") == 0, F.col("base")).otherwise(F.array_sort(F.concat("base", F.coalesce(F.filter(
            "extra", lambda x: ~F.exists("base", lambda b: (b["s"] < x["e"]) & (b["e"] > x["s"]))), none)
        ))).alias("spans"))
    return out


def span_text(spans: Column) -> Column:
    return span_list(spans, KINDS)
