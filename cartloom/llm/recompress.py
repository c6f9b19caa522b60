"""Substring dedup by recompression: remove words covered by a 20-word window whose words also start earlier.

Rounds of recompression rename the words of a text: runs of one word become one symbol, then in each round neighbouring
symbols are joined where the left one's name falls in the left class and the right one's in the right class. Names are
digests of what they stand for, so they are the same in the whole corpus without a dictionary. Whether a symbol is formed
depends on a few words around it only, its *context*; equal passages therefore hold equal symbols wherever the context
lies inside them. Each window takes its anchor from the highest round that has such a symbol inside it. Symbols that the
corpus shares, found in Spark rounds over the anchors, reveal the repeats, and the rounds in ``repeats`` verify the windows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cartloom.llm import common as C
from cartloom.llm import repeats as R

WINDOW = 20
ROUNDS = 2


def _word_symbols(data, offsets):
    codes, starts, ends, at = C.word_codes(data, offsets, C.SPACED, C.SAME)
    return codes, at, (starts, ends)


def _join_runs(code: np.ndarray, text: np.ndarray):
    """Symbols of equal neighbouring words: name, first word, end, context."""
    n = len(code)
    new = np.r_[True, (code[1:] != code[:-1]) | (text[1:] != text[:-1])] if n else np.zeros(0, bool)
    first = np.flatnonzero(new)
    end = np.r_[first[1:], n].astype(np.int64)
    size = end - first
    name = np.where(size > 1, C.mix(code[first] * C.U64(C.BASE) + size.astype(np.uint64)), code[first])
    return name, first, end, first - 1, end + 1


def _join_pairs(name, first, end, low, high, text, salt: int):
    """One round: join left-class symbols with a right-class symbol after them in the same text."""
    n = len(name)
    right = (C.mix(name + C.U64(salt)) & C.U64(1)) > 0
    same = np.r_[text[first[1:]] == text[first[:-1]], False] if n else np.zeros(0, bool)
    pair = np.zeros(n, bool)
    pair[:-1] = same[:-1] & ~right[:-1] & right[1:]
    second = np.r_[False, pair[:-1]] if n else pair
    keep = np.flatnonzero(~second)
    after = np.minimum(keep + 1, n - 1)
    joined = pair[keep]
    out_name = np.where(joined, C.mix(name[keep] * C.U64(C.BASE) + C.mix(name[after] + C.U64(salt))), name[keep])
    out_end = np.where(joined, end[after], end[keep])
    # An unjoined symbol is sure only where the neighbour it might have joined is known.
    before = np.maximum(keep - 1, 0)
    has_left = np.r_[False, same[:-1]][keep] if n else np.zeros(0, bool)
    left_end = np.where(has_left, low[before], first[keep] - 1)
    right_end = np.where(same[keep], high[after], end[keep] + 1)
    lone_right, lone_left = ~joined & right[keep], ~joined & ~right[keep]
    out_low = np.where(lone_right, np.minimum(left_end, low[keep]), low[keep])
    out_high = np.where(joined, np.maximum(high[after], high[keep]), np.where(lone_left, np.maximum(right_end, high[keep]), high[keep]))
    return out_name, first[keep], out_end, out_low, out_high


def _best(name: np.ndarray, low: np.ndarray, high: np.ndarray, n: int, window: int) -> np.ndarray:
    """For each window start, the symbol of least hash whose context lies inside the window; -1 without one."""
    out = np.full(n, -1, np.int64)
    if not len(name):
        return out
    clip = lambda a, m: np.clip(a, 0, m)
    # Contexts move to the right with the symbols, so the symbols inside a window are consecutive.
    begin = np.cumsum(np.bincount(clip(low + 1, n), minlength=n + 1))[:n]
    stop_at = np.cumsum(np.bincount(clip(high, n + 1), minlength=n + window + 2))
    stop = stop_at[np.arange(n) + window]
    key = (C.mix(name) >> C.U64(32) << C.U64(32)) | np.arange(len(name), dtype=np.uint64)
    levels = [key]
    while 2 ** len(levels) <= window:
        last, step = levels[-1], 2 ** (len(levels) - 1)
        nxt = last.copy()
        nxt[:-step] = np.minimum(last[:-step], last[step:])
        levels.append(nxt)
    table = np.stack(levels)
    some = np.flatnonzero(stop > begin)
    width = stop[some] - begin[some]
    power = np.minimum(np.floor(np.log2(width)).astype(np.int64), len(levels) - 1)
    least = np.minimum(table[power, begin[some]], table[power, stop[some] - (1 << power)])
    out[some] = (least & C.U64(0xFFFFFFFF)).astype(np.int64)
    return out


def word_anchors(window: int, rounds: int, codes: np.ndarray, at: np.ndarray):
    """Ranges of windows and the contexts of their anchors."""
    n = len(codes)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none, none, none
    text = np.repeat(np.arange(len(at) - 1), np.diff(at))
    level = _join_runs(codes, text)
    low, high = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    anchor = np.full(n, -1, np.int64)
    for salt in range(rounds + 1):
        if salt:
            level = _join_pairs(*level, text, salt)
        name, first, end, ctx_low, ctx_high = level
        best = _best(name, ctx_low, ctx_high, n, window)
        some = best >= 0
        pick = best[some]
        low[some], high[some] = ctx_low[pick], ctx_high[pick]
        anchor[some] = first[pick] * (rounds + 1) + salt
    # Inside a long run of one word no symbol is sure: such a window is its own anchor.
    lone = np.flatnonzero(anchor < 0)
    low[lone], high[lone], anchor[lone] = lone, lone + window, -1 - lone
    start, count = R._ranges(R.windows_inside(at, n, window), anchor)
    return start, count, low[start], high[start]


def word_method(window: int = WINDOW, rounds: int = ROUNDS) -> R.Method:
    def keys(p: R.Parsed, at, data):
        whole = p.rolling.slices(at, at + window)
        return whole, whole

    return R.Method(
        window=window, symbols=_word_symbols, anchors=lambda data, codes, at: word_anchors(window, rounds, codes, at), by_place=True,
        window_keys=keys,
    )


NEW = "n_words long, n_removed long, kept_sha256 string, kept_text string"


def remove_repeated_words(
    documents: DataFrame, text: str = "text", ident: str = "doc_id", window: int = WINDOW, rounds: int = ROUNDS,
    unit_bytes: int = R.UNIT_BYTES, bucket_bytes: int = R.BUCKET_BYTES,
) -> DataFrame:
    """All rows of documents plus n_words, n_removed, kept_sha256 and kept_text (words joined by one space).

    A null text has no words; a null id counts as the smallest; rows with the same id are one document as to "earlier" and
    keep what they have in the same place. Result columns replace columns of their name.
    """
    names = [f.split()[0] for f in NEW.split(", ")]
    docs = documents.drop(*names)
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [NEW])

    def finish(u: R.Unit, removed: np.ndarray) -> pa.RecordBatch:
        at, (starts, ends) = u.parsed.at, u.parsed.spans
        raw, total, gone, digest, left = u.data.tobytes(), [], [], [], []
        starts, ends, removed = starts.tolist(), ends.tolist(), removed.tolist()
        for i in range(len(at) - 1):
            a, b = int(at[i]), int(at[i + 1])
            kept = b" ".join([raw[starts[j] : ends[j]] for j in range(a, b) if not removed[j]])
            total.append(b - a)
            gone.append(sum(removed[a:b]))
            digest.append(hashlib.sha256(kept).hexdigest())
            left.append(kept.decode("utf-8"))
        return pa.RecordBatch.from_arrays(
            list(u.batch.columns) + [pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(digest), pa.array(left, pa.string())],
            names=u.batch.schema.names + names,
        )

    return R.find_repeats(docs, word_method(window, rounds), finish, schema, text, ident, unit_bytes, bucket_bytes)


def op7_substring_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return remove_repeated_words(docs).drop("text", "kept_text")
