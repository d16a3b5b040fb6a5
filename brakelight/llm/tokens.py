"""Token counts at every prefix of a text, for BPE vocabularies with byte fallback."""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SPACE = "▁"
#: segments kept per Python worker; a full cache is emptied, which costs time but never changes a count
CACHED_SEGMENTS = 300_000
CACHED_PAIRS = 1_000_000

_LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
_LETTERS = re.compile(f"[{_LATIN}]+")
_SEGMENTS = re.compile(f"{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n+")
#: where no piece mixes Latin letters with other characters, segments end there too and recur more often
_LETTER_SEGMENTS = re.compile(f"{SPACE}*[{_LATIN}]+|{SPACE}*[^{SPACE}\\n{_LATIN}]+|{SPACE}+|\\n+")


class PrefixCounter:
    """Exact token counts of every prefix of a text by dynamic programming over its prefixes.

    The encoding of a prefix ends in exactly one token. Token t can end the prefix of length i when the prefix of
    length i - len(t) ends in a token u such that the vocabulary encodes u + t as exactly [u, t]; the count is
    then one more than at i - len(t). A character outside the vocabulary is encoded as its bytes.

    No piece of the vocabulary holds a word mark after another character (checked on loading), so merges never
    cross from a word into the following mark or a line end: a text is the concatenation of segments (marks,
    then other characters), counts add up over segments, and the table of a segment can be kept for its next occurrence.
    """

    def __init__(self, model_file: str):
        import sentencepiece

        self.sp = sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.ids = {sp.id_to_piece(i): i for i in range(sp.get_piece_size())
                    if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))}
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids):
            raise ValueError("pieces that hold a word mark after other characters, or a line end, are not supported")
        mixed = any(_LETTERS.search(p) and not _LETTERS.fullmatch(p.lstrip(SPACE)) for p in self.ids)
        self.segments = (_SEGMENTS if mixed else _LETTER_SEGMENTS).findall
        #: pieces spelled backwards: a node maps the next character to the left to its node, "" to the piece's id
        self.ends: dict = {}
        for piece, i in self.ids.items():
            node = self.ends
            for ch in reversed(piece):
                node = node.setdefault(ch, {})
            node[""] = i
        self.pieces = {i: p for p, i in self.ids.items()}
        self.fits: dict[int, bool] = {}
        self.tables: dict[str, tuple[int, bytes]] = {}

    def _fit(self, u: int, t: int) -> bool:
        """Whether the vocabulary encodes the pieces u + t as exactly these two."""
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        # the line end keeps the mark that the library puts before a text apart from the pair
        got = self.sp.encode("\n" + self.pieces[u] + self.pieces[t])
        ok = self.fits[u << 32 | t] = got[-2:] == [u, t] and len(got) == self._lead + 2
        return ok

    @property
    def _lead(self) -> int:
        if not hasattr(self, "_lead_n"):
            self._lead_n = len(self.sp.encode("\n"))
        return self._lead_n

    def segment(self, seg: str) -> tuple[int, bytes]:
        """(tokens of the segment, change of the count at each character as signed bytes)."""
        got = self.tables.get(seg)
        if got is not None:
            return got
        n, ends, known, fit = len(seg), self.ends, self.fits.get, self._fit
        count, last = [0] * (n + 1), [-1] * (n + 1)
        for i in range(1, n + 1):
            node, j = ends, i
            while j:
                j -= 1
                node = node.get(seg[j])
                if node is None:
                    break
                t = node.get("")
                if t is None:
                    continue
                u = last[j]
                if u >= 0:
                    ok = known(u << 32 | t)
                    if not (fit(u, t) if ok is None else ok):
                        continue
                count[i], last[i] = count[j] + 1, t
                break
            if not count[i]:
                # outside the vocabulary: one token per byte, and nothing merges with it
                count[i] = count[i - 1] + len(seg[i - 1].encode("utf-8"))
        steps = bytes([(b - a) & 255 for a, b in zip(count, count[1:])])
        if len(self.tables) >= CACHED_SEGMENTS:
            self.tables.clear()
        if n <= 64:
            self.tables[seg] = (count[n], steps)
        return count[n], steps

    def text(self, text: str) -> tuple[int, bytes]:
        """(tokens, change of the count at each character) of a whole text; no begin or end tokens."""
        if not text:
            return 0, b""
        marked = SPACE + text.replace(" ", SPACE)
        total, steps, get, make = 0, [], self.tables.get, self.segment
        for seg in self.segments(marked):
            n, s = get(seg) or make(seg)
            total += n
            steps.append(s)
        joined = b"".join(steps)
        # the mark before the text belongs to its first character
        first = np.frombuffer(joined[:2], np.int8).astype(int).sum()
        return total, np.int8(first).tobytes() + joined[2:]


_COUNTERS: dict[str, PrefixCounter] = {}


def counter(model_file: str) -> PrefixCounter:
    """The worker's counter of a vocabulary file (loaded once per Python worker)."""
    if model_file not in _COUNTERS:
        _COUNTERS[model_file] = PrefixCounter(model_file)
    return _COUNTERS[model_file]


def count_tokens(docs: DataFrame, model_file: str, limit: int = 4096, id_col: str = "doc_id",
                 text_col: str = "text", batch_rows: int = 500) -> DataFrame:
    """One row per input row: id, n_bytes, n_chars, n_tokens, over_limit, prefix_steps.

    ``prefix_steps`` holds one signed byte per code point: how much longer the encoding of the prefix is with
    it than without it. Its running sum is the exact token count of every prefix; ``prefix_tokens`` and
    ``prefix_within`` answer truncation and budget questions from it without encoding again.

    Null text counts as empty (0 tokens); repeated rows give repeated results; an empty table gives an
    empty result; further columns are ignored. Texts of any length are counted whole, in time linear in the length.
    """
    schema = (T.StructType().add(id_col, docs.schema[id_col].dataType).add("n_bytes", "long").add("n_chars", "long")
              .add("n_tokens", "long").add("over_limit", "boolean").add("prefix_steps", "binary"))

    def run(batches):
        c = counter(model_file)
        for big in batches:
            for at in range(0, big.num_rows, batch_rows):
                b = big.slice(at, batch_rows)
                texts = [t or "" for t in b.column(1).to_pylist()]
                got = [c.text(t) for t in texts]
                yield pa.RecordBatch.from_arrays([
                    b.column(0), pa.array([len(t.encode("utf-8")) for t in texts], pa.int64()),
                    pa.array([len(t) for t in texts], pa.int64()), pa.array([n for n, _ in got], pa.int64()),
                    pa.array([n > limit for n, _ in got], pa.bool_()), pa.array([s for _, s in got], pa.binary()),
                ], names=schema.names)

    return docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text")).mapInArrow(run, schema)


@F.pandas_udf(T.LongType())
def _within(steps, budget):
    import pandas as pd

    out = []
    for s, b in zip(steps, budget):
        if s is None or b is None:
            out.append(None)
            continue
        ok = np.flatnonzero(np.cumsum(np.frombuffer(s, np.int8), dtype=np.int64) <= b)
        out.append(int(ok[-1]) + 1 if len(ok) else 0)
    return pd.Series(out, dtype="Int64")


@F.pandas_udf(T.LongType())
def _tokens_at(steps, chars):
    import pandas as pd

    return pd.Series([None if s is None or c is None else
                      int(np.frombuffer(s, np.int8)[:max(0, int(c))].sum(dtype=np.int64))
                      for s, c in zip(steps, chars)], dtype="Int64")


def prefix_within(steps: Column, budget: int | Column) -> Column:
    """Characters of the longest prefix whose encoding has at most ``budget`` tokens."""
    return _within(steps, F.lit(budget).cast("long") if isinstance(budget, int) else budget)


def prefix_tokens(steps: Column, chars: int | Column) -> Column:
    """Exact tokens of the prefix of ``chars`` characters."""
    return _tokens_at(steps, F.lit(chars).cast("long") if isinstance(chars, int) else chars)
