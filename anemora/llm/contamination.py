"""Passages of held-out items inside a corpus (problem 7).

Texts and items are brought to one form: markup, comment signs, hyphenated line breaks, accents and letter case fall
away, and numbers, units and names become typed placeholders: the template. Windows of K template words are joined by
hash with the items' windows. Where enough windows of an item lie together, the stretch of the document around them is
aligned with the item, first as templates. Then the slots are checked: where all of them hold the item's own values the
alignment stands; else each other value counts as a changed word, and the words themselves are aligned (a leak is a
passage within the allowed edits). Stretches whose template is within the allowed edits, with slots filled anew and each
value always by the same other one, are re-parameterised items.

Windows stand in two forms, with and without placeholders for names, as a name cannot be told in a text all in capitals.
Tasks get only a bit sketch of the items' windows, of a fixed size whatever the number of items; it lets a window through
that no item has now and then, which the join on the full hash then drops.

A null, empty or blank text leaks nothing; a null or empty item is never leaked. Repeated documents count for
themselves. Extra columns are not kept. Quotations of less than SURE words with edits spread evenly may leave no window
intact; they are found only if one is left.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from anemora.session import shipped, written

#: Words of a window. One edit in EDITS words leaves intact windows of this size in any passage of SURE words or more.
K = 5
EDITS = 8
SURE = 23
#: Bits of the sketch of the items' windows: 2 MB whatever the number of items.
SKETCH_BITS = 24
#: Windows of items that are broadcast, at most (some 30 bytes each); more are joined by shuffle, each under SALTS keys, so that a stock phrase is several tasks' work.
BROADCAST_WINDOWS = 1_000_000
SALTS = 8
#: Parts of the documents' windows for each shuffle partition of the session.
PARTS = 4
#: Kinds of words, and what stands for a number, a unit or a name in a template.
NUMBER, UNIT, NAME = 1, 2, 3
PLACEHOLDER = (0, 101, 102, 103)
#: Units of measurement (each also with the prefixes of the SI) and unit words.
PREFIXES = ("", "p", "n", "u", "µ", "μ", "m", "c", "d", "h", "k", "M", "G", "T")
UNITS = frozenset(p + u for p in PREFIXES for u in ("m", "g", "s", "A", "K", "mol", "Hz", "N", "Pa", "J", "W", "V", "F", "T", "eV", "l", "L", "B", "Wh", "bar", "m2", "m3"))
UNIT_WORDS = frozenset(
    "metre metres meter meters kilometre kilometres kilometer kilometers centimetre centimetres millimetre millimetres gram grams kilogram kilograms tonne tonnes second seconds minute minutes hour hours "
    "day days week weeks month months year years degree degrees percent kelvin celsius pascal watt watts joule joules volt volts hertz litre litres min h d yr ha pct".split()
)
#: A text in which more words than this begin with a capital, though inside a sentence, writes nouns so; there a name is two such words or more.
NOUNS = 0.15

#: Joined without a blank: hyphenated line breaks, invisible marks, hints where a word may be cut.
JOIN = r"\\-|[\x{ad}\x{200b}-\x{200f}\x{2060}\x{feff}]|-[ \t]*(?:\r\n|\n|\r)[ \t%]*"
ACCENT = r"\\(?:['`^\"~=.]|[cuvHkrdb](?:\s+|\{))\s*\{?\\?([A-Za-z])\}?"
LETTER = r"\\(ss|oe|ae|OE|AE|[oOlLij])\b(?:\{\})?[ ]?"
#: Replaced by a blank: formulas (without a blank line in them), commands whose arguments are not text, other commands.
MARKUP = (
    r"\\\$|\$(?:[^$\n]|\n[^$\n\s])*\$|\\\((?:[^\\\n]|\\[^)\n]|\n[^\n])*\\\)"
    r"|\\(?:[a-zA-Z]*cite[a-zA-Z]*|ref|eqref|pageref|label|includegraphics|input|include|begin|end|usepackage|vspace|hspace|url)\*?(?:\[[^\]]*\])?\{[^}]*\}"
    r"|\\[A-Za-z@]+\*?"
)


def plain_words(texts):
    """An Arrow array of texts as lists of words, still with case and accents; a decimal number is one word."""
    import pyarrow.compute as pc

    t = pc.replace_substring_regex(texts, JOIN, "")
    t = pc.replace_substring_regex(t, ACCENT, r"\1")
    t = pc.replace_substring_regex(t, LETTER, r"\1")
    t = pc.replace_substring_regex(t, MARKUP, " ")
    t = pc.replace_substring_regex(t, r"[{}]+", "")
    t = pc.replace_substring_regex(t, r"([0-9])[.,]([0-9])", r"\1\2")
    return pc.utf8_split_whitespace(pc.utf8_trim_whitespace(pc.replace_substring_regex(t, r"[^\pL\pN\pM]+", " ")))


@lru_cache(100_000)
def folded(word: str) -> str:
    """A word in small letters without accents and compatibility forms."""
    flat = unicodedata.normalize("NFKD", word.casefold())
    return "".join(c for c in flat if not unicodedata.combining(c)).replace("œ", "oe").replace("æ", "ae").replace("ø", "o").replace("ł", "l").replace("ı", "i")


class Texts:
    """A batch of texts as words: ends (of each text, in the flat arrays), codes (hashes of the folded words) and kinds."""

    def __init__(self, texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        words = plain_words(pc.fill_null(texts, "").cast(pa.large_string()))
        flat = words.flatten()
        full = pc.greater(pc.utf8_length(flat), 0).to_numpy(zero_copy_only=False)
        self.doc = np.repeat(np.arange(len(words)), pc.list_value_length(words).to_numpy(zero_copy_only=False))[full]
        self.ends = np.concatenate([[0], np.cumsum(np.bincount(self.doc, minlength=len(words)))]).astype(np.int64)
        flat = flat.filter(pa.array(full)).dictionary_encode()
        kinds = flat.dictionary.to_pylist()
        at = flat.indices.to_numpy(zero_copy_only=False)
        of = lambda f, t: np.array([f(w) for w in kinds], t)[at]
        self.codes = of(lambda w: zlib.crc32(folded(w).encode()) & 0x7FFFFFFF, np.int32)
        first = np.zeros(len(at), bool)
        first[self.ends[:-1][np.diff(self.ends) > 0]] = True
        before = lambda x: np.concatenate([x[:0], [False], x[:-1]])[: len(x)] & ~first
        number = of(str.isdigit, bool)
        unit, cased = of(lambda w: w in UNITS or w.lower() in UNIT_WORDS, bool), of(lambda w: w[:1].isupper() and not w.isupper() and len(w) > 2, bool)
        low = of(lambda w: w[:1].islower(), bool)
        units = np.zeros(len(at), bool)
        for _ in range(4):  # W m 2, km per hour: units may follow each other
            units |= unit & before(number | units)
        # the same word with a small letter elsewhere in the text: not a name
        key = self.doc.astype(np.int64) << np.int64(32) | self.codes
        name = cased & ~np.isin(key, np.unique(key[low]))
        inside = name & before(low | number)
        for _ in range(4):
            inside |= name & before(inside)
        share = np.bincount(self.doc[inside], minlength=len(words)) / np.maximum(np.diff(self.ends), 1)
        run = inside & (before(inside) | np.append(before(inside)[1:] & inside[1:], False)[: len(at)])
        name = np.where(share[self.doc] > NOUNS, run, inside)
        self.kinds = np.where(number, NUMBER, np.where(units, UNIT, np.where(name, NAME, 0))).astype(np.int8)

    def windows(self):
        """(place in the flat arrays, hash) of every template window, with the names as they are and, where it has any, with placeholders for them."""
        import numpy as np

        at = np.arange(max(0, len(self.codes) - K + 1))
        at = at[self.doc[at] == self.doc[at + K - 1]]
        named = np.zeros(len(at), bool)
        for n in range(K):
            named |= self.kinds[at + n] == NAME
        plain = window_hashes(template(self.codes, self.kinds, NAME), at)
        other = window_hashes(template(self.codes, self.kinds), at[named])
        return np.concatenate([at, at[named]]), np.concatenate([plain, other])

    def lists(self, values, kind):
        import pyarrow as pa

        return pa.ListArray.from_arrays(pa.array(self.ends, pa.int32()), pa.array(values, kind))


def template(codes, kinds, keep: int = 0):
    """Codes with placeholders for the words of a kind, but for those of the kind `keep`."""
    import numpy as np

    codes, kinds = np.asarray(codes), np.asarray(kinds)
    return np.where((kinds == 0) | (kinds == keep), codes, np.array(PLACEHOLDER, dtype=np.int32)[kinds])


def window_hashes(codes, at, k: int = K):
    """Hashes of the windows of k codes that begin at the given places; vectorised."""
    import numpy as np

    h = np.zeros(len(at), dtype=np.uint64)
    for n in range(k):
        h = (h ^ codes[at + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    return h.astype(np.int64)


@lru_cache(10_000)
def least_windows(n: int) -> int:
    """Intact windows that any allowed quotation of an item of n words has at least, and 1."""
    return max(1, min(m - m // EDITS - (K - 1) * (m // EDITS + 1) for m in range(-(-n // 2), max(n, 1) + 1)))


def _least(n: Column) -> Column:
    """least_windows as a column."""
    edits = lambda m: F.floor(m / EDITS).cast("int")
    counts = F.transform(F.sequence(F.ceil(n / 2).cast("int"), F.greatest(n, F.lit(1))), lambda m: m - edits(m) - (K - 1) * (edits(m) + 1))
    return F.greatest(F.array_min(counts), F.lit(1))


def span(n):
    """Words that an allowed quotation of an item of n words takes up in a document, at most, with a window's length to spare."""
    return n + n // (EDITS - 1) + K


def item_batches():
    """A function over Arrow batches (item_id, text) that gives (item_id, words, kinds, pos, h)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x = Texts(batch.column(1))
            at, h = x.windows()
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            edge = pa.array(np.searchsorted(at, x.ends), pa.int32())
            pos = (at - x.ends[x.doc[at]]).astype(np.int32) if len(at) else np.zeros(0, np.int32)
            columns = [batch.column(0), x.lists(x.codes, pa.int32()), x.lists(x.kinds, pa.int8()), pa.ListArray.from_arrays(edge, pa.array(pos)), pa.ListArray.from_arrays(edge, pa.array(h))]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "kinds", "pos", "h"])

    return run


def sketch(windows: DataFrame, bits: int = SKETCH_BITS):
    """Two bits for each window hash, as an array of 2 ** bits bits; what comes to the driver has this size, however many windows there are."""
    import numpy as np

    mask = (1 << bits) - 1
    bit = F.explode(F.array(F.col("h").bitwiseAND(mask) + 1, F.shiftrightunsigned("h", bits).bitwiseAND(mask) + 1))
    rows = windows.select(bit.alias("v")).groupBy(F.bitmap_bucket_number("v").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("v")).alias("bits"))
    out = np.zeros(max(1, (1 << bits) // 8), np.uint8)
    for r in rows.collect():
        part = np.frombuffer(r["bits"], np.uint8)[: len(out)]
        out[(r["b"] - 1) * 4096 :][: len(part)] = part
    return out


def _in_sketch(table, h, bits: int = SKETCH_BITS):
    import numpy as np

    def bit(x):
        x = x & np.uint64((1 << bits) - 1)
        return (table[(x >> np.uint64(3)).astype(np.int64)] >> (x & np.uint64(7)).astype(np.uint8)) & 1

    u = h.astype(np.uint64)
    return (bit(u) & bit(u >> np.uint64(bits))).astype(bool)


def _dense(doc, pos, least: int, width: int):
    """Which of the sorted places of documents lie among at least `least` different places within `width` words."""
    import numpy as np

    key = doc.astype(np.int64) << np.int64(34) | pos
    places, back = np.unique(key, return_inverse=True)
    if len(places) < least:
        return np.zeros(len(pos), bool)
    first = np.flatnonzero(places[least - 1 :] - places[: len(places) - least + 1] <= width)
    marks = np.zeros(len(places) + 1, np.int64)
    np.add.at(marks, first, 1)
    np.add.at(marks, first + least, -1)
    return (np.cumsum(marks[:-1]) > 0)[back]


def hit_batches(table, least: int, width: int, rows: int = 500, bits: int = SKETCH_BITS):
    """A function over Arrow batches (id, text) that gives (id, words, kinds, pos, h) of documents that may quote an item.

    pos, h: windows that may be an item's and lie among enough others for the easiest of all quotations.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
            x = Texts(batch.column(1))
            at, h = x.windows()
            hit = _in_sketch(table, h, bits)
            at, h = at[hit], h[hit]
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            doc = x.doc[at]
            pos = at - x.ends[doc]
            keep = _dense(doc, pos, least, width)
            edge = np.concatenate([[0], np.cumsum(np.bincount(doc[keep], minlength=len(batch)))]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(edge), pa.array(v)) for v in (pos[keep].astype(np.int32), h[keep])]
            out = pa.RecordBatch.from_arrays([batch.column(0), x.lists(x.codes, pa.int32()), x.lists(x.kinds, pa.int8()), *lists], names=["id", "words", "kinds", "pos", "h"])
            yield out.filter(pa.array(np.diff(edge) > 0))

    return run


def stretch_batches(batches: Iterator, rows: int = 300) -> Iterator:
    """Of documents' windows (id, at: dpos and the items (item_id, n, ipos) that have the window) the stretches (id, item_id, lo, hi) that hold enough windows of an item near one diagonal.

    Almost all pairs of a document and an item share a stock phrase or two; they are counted away here, before anything of them is moved.
    """
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    flags = lambda x: x.to_numpy(zero_copy_only=False)
    for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
        owner = np.repeat(np.arange(len(batch)), flags(pc.list_value_length(batch.column(1))))
        hits = batch.column(1).flatten()
        dpos, having = flags(hits.field("dpos")).astype(np.int64), hits.field("items")
        row = np.repeat(np.arange(len(hits)), flags(pc.list_value_length(having)))
        items = having.flatten()
        n, ipos, known = flags(items.field("n")), flags(items.field("ipos")), items.field("item_id").dictionary_encode()
        pair = owner[row] * np.int64(len(known.dictionary) + 1) + flags(known.indices)
        wide = np.int64(ipos.max(initial=0)) + 1
        pairs, common = np.unique(np.unique(pair * wide + ipos) // wide, return_counts=True)
        _, first, back = np.unique(pair, return_index=True, return_inverse=True)
        least = np.array([least_windows(k) for k in range(int(n.max(initial=0)) + 1)])[n[first]]
        keep = np.flatnonzero((common >= least)[back])
        keep = keep[np.lexsort((dpos[row[keep]], pair[keep]))]
        ids, doc, lo, hi = [], [], [], []
        edges = np.flatnonzero(np.diff(pair[keep], prepend=-1, append=-1) != 0) if len(keep) else np.zeros(1, int)
        for a, b in zip(edges, edges[1:]):
            part = keep[a:b]
            size, d, p = int(n[part[0]]), dpos[row[part]], ipos[part]
            for piece in np.split(np.arange(len(d)), np.flatnonzero(np.diff(d) > span(size)) + 1):
                shift = np.sort(d[piece] - p[piece])
                together = np.searchsorted(shift, shift + size // (EDITS - 1) + 1, side="right") - np.arange(len(shift))
                if together.max() >= least_windows(size):
                    doc.append(owner[row[part[0]]])
                    ids.append(part[0])
                    lo.append(max(0, d[piece[0]] - span(size)))
                    hi.append(d[piece[-1]] + span(size))
        columns = [batch.column(0).take(pa.array(doc, pa.int64())), items.field("item_id").take(pa.array(ids, pa.int64())), pa.array(lo, pa.int32()), pa.array(hi, pa.int32())]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "item_id", "lo", "hi"])


def align(items: list, docs: list, cost: int = 4):
    """For each pair of an item and a stretch of a document: words matched and edits of their best local alignment.

    The score is matches - cost * edits; all pairs of a batch go through the document's words together.
    """
    import numpy as np

    unit = 1 << 20
    n, m = max(map(len, items)), max(map(len, docs))
    a = np.full((len(items), n), -99, dtype=np.int64)
    b = np.full((len(docs), m), -98, dtype=np.int64)
    for r, (x, y) in enumerate(zip(items, docs)):
        a[r, : len(x)], b[r, : len(y)] = x, y
    step = np.arange(n + 1) * cost * unit
    s = np.zeros((len(items), n + 1), dtype=np.int64)
    best = np.zeros(len(items), dtype=np.int64)
    for j in range(m):
        t = np.zeros_like(s)
        t[:, 1:] = np.maximum(s[:, 1:], np.where(a == b[:, j, None], s[:, :-1] + (cost + 1) * unit + 1, s[:, :-1])) - cost * unit
        np.maximum(t, 0, out=t)
        t = np.maximum.accumulate(t + step, axis=1) - step
        s = np.maximum(t, 0)
        best = np.maximum(best, s.max(axis=1))
    matched = best & (unit - 1)
    return matched, (matched - (best >> 20)) // cost


def most_matched(items: list, docs: list):
    """For each pair, by number of edits: the most words that any alignment of any two stretches matches with at most so many.

    An array (pairs, edits); edits go up to the most an item's words allow. State (e, c) stands at word c + e of the item,
    so that words dropped from the item run down the first of the two.
    """
    import numpy as np

    n, m = max(map(len, items)), max(map(len, docs))
    edits = n // (EDITS - 1)
    a = np.full((len(items), n), -99, dtype=np.int64)
    b = np.full((len(docs), m), -98, dtype=np.int64)
    for r, (x, y) in enumerate(zip(items, docs)):
        a[r, : len(x)], b[r, : len(y)] = x, y
    at = np.arange(edits + 1)[:, None] + np.arange(-edits, n + 1)[None, :] - 1
    words = np.where((at >= 0) & (at < n), a[:, np.clip(at, 0, n - 1)], -99)
    s = np.zeros(words.shape, dtype=np.int16)
    best = np.zeros(words.shape[:2], dtype=np.int16)
    for j in range(m):
        t = np.zeros_like(s)
        t[:, :, 1:] = np.where(words[:, :, 1:] == b[:, j, None, None], s[:, :, :-1] + 1, 0)
        t[:, 1:] = np.maximum(t[:, 1:], s[:, :-1])
        t[:, 1:, :-1] = np.maximum(t[:, 1:, :-1], s[:, :-1, 1:])
        s = np.maximum.accumulate(t, axis=1)
        best = np.maximum(best, s.max(axis=2))
    return best


def leaks(items: list, docs: list, matched, edits, cost: int = 4):
    """Whether any stretch repeats at least half of the item's words with at most one edit in EDITS words.

    matched and edits are those of align(). Its alignment may be such a stretch itself; a score below what any such stretch
    has rules all of them out. Other pairs, as those with edits near the ends of a quotation, are searched by number of edits.
    """
    import numpy as np

    n = np.array([len(x) for x in items])
    found = (matched * 2 >= n) & (edits * EDITS <= matched + edits)
    open_ = np.flatnonzero(~found & ((matched - cost * edits) * 2 * (EDITS - 1) >= n * (EDITS - 1 - cost)))
    for at in range(0, len(open_), 32):
        part = open_[at : at + 32]
        best = most_matched([items[k] for k in part], [docs[k] for k in part])
        found[part] = ((best * 2 >= n[part, None]) & (best >= np.arange(best.shape[1]) * (EDITS - 1))).any(axis=1)
    return found


def _as_item(codes, kinds, item, item_kinds):
    """Kinds of a stretch's words, with those of words that the item has too as they are there."""
    import numpy as np

    order = np.argsort(item, kind="stable")
    at = np.clip(np.searchsorted(item[order], codes), 0, len(item) - 1)
    return np.where(item[order][at] == codes, item_kinds[order][at], kinds)


def slots(item, item_kinds, doc, doc_kinds) -> tuple[int, bool]:
    """Slots of an item that a stretch with the same template fills with another value, and whether each value has one counterpart throughout."""
    from difflib import SequenceMatcher

    a, b = template(item, item_kinds), template(doc, doc_kinds)
    pairs = []
    for block in SequenceMatcher(None, a.tolist(), b.tolist(), autojunk=False).get_matching_blocks():
        pairs += [(int(item[block.a + k]), int(doc[block.b + k])) for k in range(block.size) if item_kinds[block.a + k]]
    values: dict[int, set[int]] = {}
    for x, y in pairs:
        values.setdefault(x, set()).add(y)
    return sum(x != y for x, y in pairs), all(len(v) == 1 for v in values.values())


def verified_batches(batches: Iterator) -> Iterator:
    """Of stretches (id, item_id, words, kinds, item, item_kinds) gives (id, item_id, n, matched, edits, same_template, leaked, refilled, consistent).

    matched, edits and same_template are of the templates, leaked is of the words themselves.
    """
    import numpy as np
    import pandas as pd

    for pdf in batches:
        pdf = pdf.iloc[np.argsort(pdf["words"].map(len).to_numpy(), kind="stable")]
        for at in range(0, len(pdf), 256):
            part = pdf.iloc[at : at + 256]
            as_arrays = lambda c, t, part=part: [np.asarray(x, dtype=t) for x in part[c]]
            items, docs, doc_kinds = as_arrays("item", np.int32), as_arrays("words", np.int32), as_arrays("kinds", np.int8)
            item_kinds = [_as_item(x, k, x[o], k[o]) for x, k in zip(items, as_arrays("item_kinds", np.int8)) for o in [np.argsort(-k, kind="stable")]]
            doc_kinds = [_as_item(d, k, x, xk) for d, k, x, xk in zip(docs, doc_kinds, items, item_kinds)]
            a, b = [template(x, k) for x, k in zip(items, item_kinds)], [template(x, k) for x, k in zip(docs, doc_kinds)]
            matched, edits = align(a, b)
            same = leaks(a, b, matched, edits)
            # the slot check: of a template without slots nothing is left to compare
            found, refilled, consistent = same.copy(), np.zeros(len(part), np.int32), np.ones(len(part), bool)
            check = [k for k in np.flatnonzero(same) if item_kinds[k].any()]
            if check:
                x, d = [items[k] for k in check], [docs[k] for k in check]
                found[check] = leaks(x, d, *align(x, d))
                for k in check:
                    refilled[k], consistent[k] = slots(items[k], item_kinds[k], docs[k], doc_kinds[k])
            yield pd.DataFrame({"id": part["id"], "item_id": part["item_id"], "n": [len(x) for x in items], "matched": matched, "edits": edits, "same_template": same, "leaked": found, "refilled": refilled, "consistent": consistent})


def matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id", text_col: str = "text", broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(id, item_id, n, matched, edits, same_template, leaked, refilled, consistent) of every stretch that may be a quotation."""
    spark = docs.sparkSession
    shipped(spark)
    kind, item_kind = dict(docs.dtypes)[id_col], dict(items.dtypes)[item_col]
    lists = "words array<int>, kinds array<tinyint>, pos array<int>, h array<bigint>"
    known = items.select(F.col(item_col).alias("item_id"), F.col(text_col).alias("text")).filter(F.col("item_id").isNotNull())
    known = written(known.mapInArrow(item_batches(), f"item_id {item_kind}, {lists}").withColumn("n", F.size("words")).filter("n > 0").withColumn("least", _least(F.col("n"))), "items")
    windows = written(known.select("item_id", "n", F.inline(F.arrays_zip(F.col("pos").alias("ipos"), "h"))).distinct(), "windows")
    easiest = known.agg(F.min("least").alias("least"), F.max("n").alias("n")).first()
    table = sketch(windows)
    coded = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(hit_batches(table, easiest["least"] or 1, span(easiest["n"] or 0)), f"id {kind}, {lists}")
    coded = written(coded, "coded")
    having = windows.groupBy("h").agg(F.collect_list(F.struct("item_id", "n", "ipos")).alias("items"))
    # one row a document is moved, with its windows; what an item has in common with it is then counted where the document is;
    # parts are small, as a document's windows with all items that have them take up many times what is moved
    parts = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hits = coded.select("id", "pos", "h").repartition(parts, "id").select("id", F.inline(F.arrays_zip(F.col("pos").alias("dpos"), "h")))
    count = windows.count()
    if count <= broadcast_windows:
        both = hits.join(F.broadcast(having), "h")
    else:
        both = hits.withColumn("salt", F.pmod("dpos", F.lit(SALTS))).join(having.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), ["h", "salt"])
    together = both.groupBy("id").agg(F.collect_list(F.struct("dpos", "items")).alias("at"))
    places = written(together.mapInArrow(stretch_batches, f"id {kind}, item_id {item_kind}, lo int, hi int"), "stretches")
    cut = lambda c: F.slice(c, F.col("lo") + 1, F.col("hi") - F.col("lo"))
    near = coded.select("id", "words", "kinds").join(places, "id").select("id", "item_id", cut("words").alias("words"), cut("kinds").alias("kinds"))
    near = near.join(known.select("item_id", F.col("words").alias("item"), F.col("kinds").alias("item_kinds")), "item_id")
    # alignment costs by the pair, so pairs are dealt out by number
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), places.count() // 2000)
    near = near.select("id", "item_id", "words", "kinds", "item", "item_kinds").repartition(tasks)
    schema = f"id {kind}, item_id {item_kind}, n int, matched int, edits int, same_template boolean, leaked boolean, refilled int, consistent boolean"
    return near.mapInPandas(verified_batches, schema).withColumnRenamed("id", id_col).withColumnRenamed("item_id", item_col)


def leaked(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, item_id): at least half of the item's words in its order, at most one in EDITS changed, dropped or added."""
    return matches(docs, items, id_col, **options).filter("leaked").select(id_col, "item_id").distinct()


def reparameterised(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """(id, item_id, n, matched, edits, refilled): pairs of the same template, half of it at least, with slots filled anew, each value replaced by the same one throughout."""
    out = matches(docs, items, id_col, **options).filter(F.col("same_template") & (F.col("refilled") > 0) & F.col("consistent"))
    best = out.groupBy(id_col, "item_id").agg(F.max(F.struct("matched", "edits", "n", "refilled")).alias("m"))
    return best.select(id_col, "item_id", "m.n", "m.matched", "m.edits", "m.refilled")
