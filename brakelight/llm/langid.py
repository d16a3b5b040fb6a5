"""Language identification: scripts narrow the candidates, Viterbi labels the words of mixed-language texts."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slices

UNKNOWN = "und"
_WORD = re.compile(r"[^\W\d_]+")
#: fixed values: first and last code point of the blocks of each script
SCRIPTS = {
    "latin": [(0x41, 0x24F), (0x1E00, 0x1EFF), (0x2C60, 0x2C7F), (0xA720, 0xA7FF)],
    "greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "cyrillic": [(0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F)],
    "armenian": [(0x530, 0x58F)],
    "hebrew": [(0x590, 0x5FF)],
    "arabic": [(0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF)],
    "devanagari": [(0x900, 0x97F)],
    "bengali": [(0x980, 0x9FF)],
    "tamil": [(0xB80, 0xBFF)],
    "thai": [(0xE00, 0xE7F)],
    "georgian": [(0x10A0, 0x10FF)],
    "hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "kana": [(0x3040, 0x30FF)],
    "han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
}
_STARTS, _OWNERS = zip(*sorted([(lo, k) for k, rs in enumerate(SCRIPTS.values()) for lo, _ in rs]
                               + [(hi + 1, -1) for rs in SCRIPTS.values() for _, hi in rs
                                  if not any(lo == hi + 1 for q in SCRIPTS.values() for lo, _ in q)]))
_STARTS, _OWNERS = np.asarray(_STARTS), np.asarray(_OWNERS)


def script_of(code_points: np.ndarray) -> np.ndarray:
    """Index into SCRIPTS of each code point, -1 for others."""
    at = np.searchsorted(_STARTS, code_points, side="right") - 1
    return np.where(at >= 0, _OWNERS[at], -1)


def _grams(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashed bucket of every 2- and 3-gram of ``^word$``, index of its word, script of each word)."""
    lens = np.fromiter(map(len, words), np.int64, len(words)) + 2
    cp = np.frombuffer(("\x02" + "\x03\x02".join(words) + "\x03").encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.cumsum(lens)
    word = np.repeat(np.arange(len(words)), lens)
    two = cp[:-1] * np.uint64(0x9E3779B97F4A7C15) + cp[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    three = two[:-1] * np.uint64(0x165667B19E3779F9) + cp[2:] * np.uint64(0x27D4EB2F165667C5)
    ok2, ok3 = word[:-1] == word[1:], word[:-2] == word[2:]
    h = np.concatenate([two[ok2], three[ok3] ^ np.uint64(0x5555555555555555)])
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return ((h >> np.uint64(40)) % np.uint64(buckets)).astype(np.int64), np.concatenate(
        [word[:-1][ok2], word[:-2][ok3]]), script_of(cp[ends - lens + 1].astype(np.int64))


class Model:
    """Per-language log probabilities of hashed character n-grams, and the scripts each language is written in."""

    def __init__(self, languages: list[str], counts: np.ndarray, scripts: np.ndarray, smooth: float = 0.5):
        self.languages, self.buckets = languages, counts.shape[1]
        self.logp = np.log((counts + smooth) / (counts.sum(1, keepdims=True) + smooth * counts.shape[1])).T.astype(np.float32)
        share = scripts / np.maximum(1, scripts.sum(1, keepdims=True))
        self.writes = share >= 0.01  # language x script (the last column: other letters)

    def score(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(words x languages scores, words x languages whether the language is written in the word's script).

        Languages that are not written in the script of a word are out of the running for it; where no learned
        language is, all stay in.
        """
        g, w, s = _grams([x.lower() for x in words], self.buckets)
        out = np.empty((len(words), len(self.languages)), np.float32)
        for j in range(len(self.languages)):
            out[:, j] = np.bincount(w, weights=self.logp[g, j], minlength=len(words))
        may = self.writes[:, s].T
        out[~may & may.any(1, keepdims=True)] -= 1000.0
        return out, may


def viterbi(scores: np.ndarray, lens: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every word. ``scores``: words of all texts one after the other; ``lens``: words per text.

    All texts step forward together, longest first; changing the label between two words costs ``penalty``.
    """
    n, k = scores.shape
    order = np.argsort(-lens, kind="stable")
    size, first = lens[order], (np.cumsum(lens) - lens)[order]
    back = np.empty((n, k), np.uint8 if k <= 256 else np.uint16)
    own = np.arange(k)
    longest = int(size[0]) if len(size) else 0
    alive = np.searchsorted(-size, -np.arange(longest), side="left") if longest else []
    v = np.zeros((len(size), k), np.float64)
    for t in range(longest):
        m = alive[t]
        rows = first[:m] + t
        if t:
            top = v[:m].argmax(1)
            change = v[np.arange(m), top] - penalty
            stay = v[:m] >= change[:, None]
            back[rows] = np.where(stay, own, top[:, None])
            v[:m] = np.where(stay, v[:m], change[:, None]) + scores[rows]
        else:
            v[:m] = scores[rows]
    labels = np.empty(n, back.dtype)
    state = v.argmax(1)
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        rows = first[:m] + t
        labels[rows] = state[:m]
        if t:
            state[:m] = np.where(size[:m] > t, back[rows, state[:m]], state[:m])
    return labels


def is_held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample_rows: int = 20_000, buckets: int = 1 << 14, id_col: str = "doc_id",
          text_col: str = "text", lang_col: str = "lang") -> Model | None:
    """Fit on about ``sample_rows`` labelled rows (chosen by a hash of the id) that are not held out.

    Tasks count n-grams per language; the counts are summed by Spark and at most languages x ``buckets`` rows
    reach the driver. None when no row is labelled.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang")).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & ~is_held_out("id"))
    total = labelled.count()
    share = min(1.0, sample_rows / max(1, total))
    sample = labelled.filter(F.pmod(F.xxhash64("id", F.lit("sample")), F.lit(1_000_000)) < int(share * 1_000_000) + 1)
    schema = T.StructType().add("lang", "string").add("slot", "integer").add("n", "long")
    others = len(SCRIPTS)

    def count(batches):
        # slots: n-gram buckets, then one per script
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = _WORD.findall(text.lower())
                if found:
                    g, _, s = _grams(found, buckets)
                    c = sums.setdefault(lang, np.zeros(buckets + others + 1, np.int64))
                    c[:buckets] += np.bincount(g, minlength=buckets)
                    c[buckets:] += np.bincount(np.where(s < 0, others, s), minlength=others + 1)
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(c[at])],
                                             names=schema.names)

    rows = (sample.select("text", "lang").mapInArrow(count, schema).groupBy("lang", "slot")
            .agg(F.sum("n").alias("n"))).collect()
    if not rows:
        return None
    languages = sorted({r["lang"] for r in rows})
    at = {x: i for i, x in enumerate(languages)}
    c = np.zeros((len(languages), buckets + others + 1), np.float64)
    for r in rows:
        c[at[r["lang"]], r["slot"]] = r["n"]
    return Model(languages, c[:, :buckets], c[:, buckets:])


class _Vocabulary(dict):
    """Word -> row of the score table; unseen words are queued for scoring."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word):
        i = self[word] = len(self)
        self.new.append(word)
        return i


class _Labeler:
    """A worker's scores of the words seen so far; forgotten when there are too many, which changes no score."""

    def __init__(self, model: Model, cached: int = 200_000):
        self.model, self.cached = model, cached
        self._clear()

    def _clear(self):
        k = len(self.model.languages)
        self.words, self.scores = _Vocabulary(), np.empty((0, k), np.float32)
        self.may, self.chars = np.empty((0, k), bool), np.empty(0, np.int64)

    def texts(self, texts: list[str | None], penalty: float):
        """(label, score, spans, fit) of each text."""
        if len(self.words) > self.cached:
            self._clear()
        rows = []
        for t in texts:
            found = _WORD.findall(t) if t else []
            rows.append(np.fromiter(map(self.words.__getitem__, found), np.int32, len(found)))
        new, self.words.new = self.words.new, []
        if new:
            s, may = self.model.score(new)
            self.scores, self.may = np.concatenate([self.scores, s]), np.concatenate([self.may, may])
            self.chars = np.concatenate([self.chars, np.fromiter(map(len, new), np.int64, len(new))])
        lens = np.fromiter(map(len, rows), np.int64, len(rows))
        every = np.concatenate(rows) if rows else np.empty(0, np.int32)
        labels = viterbi(self.scores[every], lens, penalty) if len(every) else np.empty(0, np.uint8)
        chars, at, k, names = self.chars[every], 0, len(self.model.languages), self.model.languages
        fits = self.may[every, labels] if len(every) else np.empty(0, bool)
        for n in lens.tolist():
            if not n:
                yield UNKNOWN, 0.0, "", 0.0
                continue
            lab, ch = labels[at:at + n], chars[at:at + n]
            weight = np.bincount(lab, weights=ch, minlength=k)
            best = int(weight.argmax())
            sure = float(ch[(lab == best) & fits[at:at + n]].sum() / ch.sum())
            cut = np.flatnonzero(np.diff(lab)) + 1
            starts, ends = [0, *cut.tolist()], [*cut.tolist(), n]
            yield names[best], sure, ",".join(f"{names[lab[s]]}:{s}:{e}" for s, e in zip(starts, ends)), float(
                ch[fits[at:at + n]].sum() / ch.sum())
            at += n


#: bytes of text that are labelled at once
SLICE_BYTES = 2 << 20


def identify(docs: DataFrame, model: Model | None, penalty: float = 12.0,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, spans, fit.

    Every word of a whole text is scored for the languages written in its script; Viterbi over the words, with
    ``penalty`` nats for a change of language, labels them. ``lang_pred`` labels most letters; ``score`` is the
    share of letters labelled so in a script of that language; ``spans`` lists ``language:first word:end``;
    ``fit`` is the share of letters in words whose label fits their script, whatever the language.

    Null text, text without letters, or a missing model gives ``und``, 0.0 and no spans. Repeated rows give repeated
    results; ties go to the first language by name; an empty table gives an empty result; further columns are ignored.
    """
    schema = (T.StructType().add(id_col, docs.schema[id_col].dataType).add("held_out", "boolean")
              .add("lang_pred", "string").add("score", "double").add("spans", "string").add("fit", "double"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded: languages x buckets

    def run(batches):
        labeler = _Labeler(shared.value) if shared.value is not None else None
        for big in batches:
            for b in slices(big, 2, SLICE_BYTES):
                texts = b.column(2).to_pylist()
                got = list(labeler.texts(texts, penalty)) if labeler else [(UNKNOWN, 0.0, "", 0.0)] * len(texts)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), pa.array([g[0] for g in got], pa.string()),
                     pa.array([g[1] for g in got], pa.float64()), pa.array([g[2] for g in got], pa.string()), pa.array([g[3] for g in got], pa.float64())],
                    names=schema.names)

    rows = docs.select(F.col(id_col).alias("id"), is_held_out(id_col).alias("h"), F.col(text_col).cast("string").alias("t"))
    return rows.mapInArrow(run, schema)
