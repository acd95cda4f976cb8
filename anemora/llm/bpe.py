"""Exact byte-level BPE of whole texts by per-prefix dynamic programming (problem 6).

For every prefix of a piece exactly one token can end its encoding. An automaton over the vocabulary finds all tokens
that end at a position; of these the one is kept that is compatible with the token kept for the prefix before it.
Following the kept tokens back from the end gives the ids. Two neighbours are compatible if no merge across their
border would have come first.

Texts are first cut in front of white space, where no piece of the tokenizer's own split pattern crosses;
each batch's distinct cuts are encoded once and kept. A null or an empty text gives an empty list.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.session import shipped

#: Folder of the public tokenizers' files.
TOKENIZERS = "/opt/tokenizers"
#: Pieces and cuts that a worker keeps; beyond it begins anew.
KEPT = 400_000

#: Fixed value: how the tokenizer splits a text into pieces.
PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s+(?!\S)|\s+"
#: White space, as the split pattern means it.
SPACE = r"\t-\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"


def byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary file: printable ones for themselves, the others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(rest)}


class PrefixEncoder:
    """A vocabulary with its automaton and merge borders."""

    def __init__(self, path: str):
        import ahocorasick
        import regex

        letters = byte_letters()
        model = json.load(open(path, encoding="utf-8"))["model"]
        plain = lambda s: "".join(chr(letters[c]) for c in s)  # noqa: E731  (a byte is one letter)
        ids = {plain(s): n for s, n in model["vocab"].items() if all(c in letters for c in s)}
        self.merge: dict[tuple[int, int], tuple[int, int]] = {}
        halves: dict[int, tuple[int, int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            left, right = (plain(s) for s in (pair.split(" ") if isinstance(pair, str) else pair))
            whole = ids[left + right]
            self.merge[ids[left], ids[right]] = (rank, whole)
            halves.setdefault(whole, (rank, ids[left], ids[right]))
        # the parts that a token's right (left) border has been, outermost first, each with the rank at which it went into the next
        top = len(model["merges"])
        self.right = {t: self._spine(t, 2, halves, top) for t in ids.values()}
        self.left = {t: self._spine(t, 1, halves, top) for t in ids.values()}
        sound: dict[int, bool] = {}
        for s, t in sorted(ids.items(), key=lambda x: len(x[0])):
            if t not in halves:
                sound[t] = len(s) == 1
                continue
            rank, a, b = halves[t]
            sound[t] = sound.get(a, False) and sound.get(b, False) and self._free(a, b, rank)
        self.compatible = lru_cache(KEPT)(lambda a, b: self._free(a, b, top))
        self.words = ahocorasick.Automaton()
        for s, t in ids.items():
            if sound[t]:
                self.words.add_word(s, (len(s), t))
        self.words.make_automaton()
        self.pieces = regex.compile(PIECES)
        self.cache: dict[str, list[int]] = {}

    @staticmethod
    def _spine(t: int, side: int, halves: dict[int, tuple[int, int, int]], top: int) -> list[tuple[int, int]]:
        out, until = [], top
        while True:
            out.append((t, until))
            if t not in halves:
                return out
            until, t = halves[t][0], halves[t][side]

    def _free(self, a: int, b: int, before: int) -> bool:
        """No merge across the border of a and b comes before one of their own that uses up a part, or before rank `before`.

        Of equal merges the left one comes first: one within a then precedes the border's, one within b follows it.
        """
        for x, x_until in self.right[a]:
            for y, y_until in self.left[b]:
                m = self.merge.get((x, y))
                if m and m[0] < min(x_until, before) and m[0] <= y_until:
                    return False
        return True

    def piece(self, text: str) -> list[int]:
        """The ids of one piece, given with one letter a byte."""
        n = len(text)
        last: list[tuple[int, int] | None] = [None] * (n + 1)
        compatible = self.compatible
        for end, (size, t) in self.words.iter(text):
            end += 1
            if last[end] is None:
                start = end - size
                if not start or (last[start] is not None and compatible(last[start][1], t)):
                    last[end] = (start, t)
        out = []
        while n:
            n, t = last[n]
            out.append(t)
        out.reverse()
        return out

    def encode(self, text: str) -> list[int]:
        """The ids of a text."""
        out: list[int] = []
        cache = self.cache
        for p in self.pieces.findall(text):
            if (got := cache.get(p)) is None:
                if len(cache) >= KEPT:
                    cache.clear()
                got = cache[p] = self.piece(p.encode("utf-8").decode("latin-1"))
            out += got
        return out


@lru_cache(1)
def encoder(path: str) -> PrefixEncoder:
    """The encoder of a vocabulary file, from the file that came with the job where the node has none at that path."""
    return PrefixEncoder(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def marked(texts):
    """Texts with a mark in front of every white space at which they may be cut.

    A blank may be cut off in front unless more white space is on both its sides, or before it at the end of the text;
    the few texts with such a place get their marks from the slower general pattern.
    """
    import pyarrow.compute as pc

    out = pc.replace_substring(texts, " ", "\0 ")
    odd = pc.match_substring_regex(texts, f"[{SPACE}] (?:[{SPACE}]|\\z)")
    return pc.replace_with_mask(out, odd, pc.replace_substring_regex(texts.filter(odd), f"([{SPACE}]*[^{SPACE}]+)", "\\1\0"))


def encode_batches(path: str, rows: int = 2500):
    """A function over Arrow batches (id, text) that gives (id, ids)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        bpe = encoder(path)
        kept: dict[str, list[int]] = {}
        for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
            texts = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            if pc.any(pc.match_substring(texts, "\0")).as_py():
                ids = pa.array([bpe.encode(t) for t in texts.to_pylist()], pa.list_(pa.int32()))
            else:
                cuts = pc.split_pattern(marked(texts), "\0")
                coded = cuts.values.dictionary_encode()
                lists = []
                for cut in coded.dictionary.to_pylist():
                    if (got := kept.get(cut)) is None:
                        if len(kept) >= KEPT:
                            kept.clear()
                        got = kept[cut] = bpe.encode(cut)
                    lists.append(got)
                flat = np.fromiter(chain.from_iterable(lists), np.int32)
                size = np.fromiter(map(len, lists), np.int32, len(lists))
                known = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(size)]), pa.int32()), pa.array(flat))
                ends = np.concatenate([[0], np.cumsum(size[coded.indices.to_numpy()], dtype=np.int64)])
                at = ends[cuts.offsets.to_numpy() - cuts.offsets[0].as_py()]
                ids = pa.ListArray.from_arrays(pa.array(at, pa.int32()), known.take(coded.indices).flatten())
            yield pa.RecordBatch.from_arrays([batch.column(0), ids], names=["id", "ids"])

    return run


def token_ids(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", tokenizers: str = TOKENIZERS, name: str = "byte_bpe_50k") -> DataFrame:
    """(id, ids): every text as the ids of a byte-level BPE vocabulary, without special tokens.

    One row per input row. The vocabulary file goes to the tasks with the job. Special tokens' strings within a text are ordinary text. Extra columns are not kept.
    """
    shipped(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    docs.sparkSession.sparkContext.addFile(f"{tokenizers}/{name}.json")
    out = rows.mapInArrow(encode_batches(f"{tokenizers}/{name}.json"), f"id {kind}, ids array<int>")
    return out.withColumnRenamed("id", id_col)
