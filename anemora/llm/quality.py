"""Per-document quality statistics and fixed-threshold rules with a reason per failure (problem 8).

Texts come as Arrow batches; lines and words are taken apart once, each different line and word is classed once, and all
statistics of a batch's documents are sums over those classes. Rows are never moved. A document fails by the published
rules below, or where words that are common in prose, list entries, table rows and macro definitions aside, are less
than half as frequent, for the text's characters, as in documents that pass the published rules: then it consists mainly of something else. Every
failure is recorded as a reason.

A null, empty or blank text has statistics of 0 or null and fails no rule. Repeated documents count for themselves. Extra
columns are not kept. With an empty word list, and where no document passes the published rules, prose_share judges nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from anemora.session import shipped, written

#: Words of the list that go to the tasks themselves; a longer list is joined (see statistics).
TASK_WORDS = 50_000
#: Published rules, lowest and highest allowed value. Rae et al. 2021 (quality and repetition rules), but for punctuated_lines: Penedo et al. 2024.
RULES = {
    "mean_word_length": (3.0, 10.0), "symbol_ratio": (0.0, 0.1), "bullet_lines": (0.0, 0.9), "ellipsis_lines": (0.0, 0.3), "alpha_words": (0.8, 1.0), "stop_words": (2.0, None),
    "duplicate_lines": (0.0, 0.3), "top_2gram": (0.0, 0.2), "top_3gram": (0.0, 0.18), "top_4gram": (0.0, 0.16), "punctuated_lines": (0.12, 1.0),
}
#: Published rule of the same source for the number of words. It is recorded as outside_length and fails nobody, as short and long prose is prose;
#: the repetition rules were published for texts that pass it and judge no shorter ones.
LENGTH = (50, 100_000)
REPETITION = ("top_2gram", "top_3gram", "top_4gram")
#: A document consists mainly of what is not prose if it has less than this part of the common words that prose has.
MAINLY = 0.5

#: Whole lines: packages; list and table environments; list entries; table rows; macro definitions.
PACKAGE = r"^[ \t]*\\(?:documentclass|documentstyle|usepackage)\b"
OPENS, CLOSES = (r"\\%s\{(?:thebibliography|itemize|enumerate|description|tabular|table|longtable|theindex|verbatim)\*?\}" % w for w in ("begin", "end"))
BULLET = r"^[ \t%]*(?:\\item|\\bibitem|\\bullet|[-*•·–] )"
LIST_LINE = BULLET + r"|^[ \t%]*(?:\(?\d{1,4}[.)] |\[\d{1,4}\]|\\contentsline|\\newglossaryentry|\\index)|(?:;[^;.]{1,40}){3}"
TABLE_LINE = r"^[^&]{0,60}&[^&]{0,60}&|^[^|]{0,60}\|[^|]{0,60}\||^[^\t]{1,60}\t[^\t]{0,60}(?:\t.{0,60})?$"
MACRO_LINE = r"^[ \t]*\\(?:(?:re|provide)?newcommand|[gex]?def\b|let\b)"
ELLIPSIS = r"(?:\.\.\.|…)[\d\s.]*$"
#: Markup within a line: formulas, commands whose arguments are not text, accents, other commands, cell and row marks.
MARKUP = (
    (r"\$[^$]{0,200}\$", " "),
    (r"\\(?:[a-zA-Z]*cite[a-zA-Z]*|ref|eqref|label|input|include|begin|end|vspace|hspace|includegraphics)\*?(?:\[[^\]]*\])?\{[^}]*\}", ""),
    (r"\\['`^\"~=.]\s*\{?\\?([A-Za-z])\}?", r"\1"),
    (r"\\\\|\\[a-zA-Z@]+\*?|[{}~&]", " "),
)
STATISTICS = (
    "n_chars bigint, n_words bigint, n_lines bigint, mean_word_length double, symbol_ratio double, alpha_words double, bullet_lines double, ellipsis_lines double, table_lines double, "
    "list_lines double, punctuated_lines double, duplicate_lines double, top_2gram double, top_3gram double, top_4gram double, stop_words double, common_share double, prose_common double"
)


def bare(lines):
    """An Arrow array of lines without markup."""
    import pyarrow.compute as pc

    for pattern, to in MARKUP:
        lines = pc.replace_substring_regex(lines, pattern, to)
    return pc.utf8_trim_whitespace(lines)


def _top_gram(x, k: int, docs: int):
    """For each document the characters that its most frequent run of k words takes up; 0 if none comes twice."""
    import numpy as np

    out = np.zeros(docs)
    at = np.arange(max(0, len(x.codes) - k + 1))
    at = at[x.wdoc[at] == x.wdoc[at + k - 1]]
    h = x.wdoc[at].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    for n in range(k):
        h = (h ^ x.codes[at + n].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    _, first, count = np.unique(h, return_index=True, return_counts=True)
    first = at[first]
    np.maximum.at(out, x.wdoc[first], sum(x.length[x.codes[first + n]] for n in range(k)) * np.where(count > 1, count, 0))
    return out


class Parts:
    """The lines and words of a batch of texts, flat, with the document (doc, wdoc) and, of words, the line (at) they are of."""

    def __init__(self, texts):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        flags = lambda x: x.to_numpy(zero_copy_only=False)
        split = lambda x: (x.flatten(), np.repeat(np.arange(len(x)), flags(pc.list_value_length(x))))
        body = pc.replace_substring_regex(texts, r"(?s)^.*?\\begin\{document\}", "")
        lines, doc = split(pc.split_pattern(pc.replace_substring_regex(body, r"\r\n?", "\n"), "\n"))
        filled = ~flags(pc.match_substring_regex(lines, r"^[\s\pZ\pC]*$")) & ~flags(pc.match_substring_regex(lines, PACKAGE))
        first = np.concatenate([[True], ~filled])[:-1]
        self.lines, self.doc, first = lines.filter(pa.array(filled)), doc[filled], first[filled]
        self.has = lambda pattern, x=self.lines: flags(pc.match_substring_regex(x, pattern))
        text = bare(self.lines)
        new_doc = np.diff(self.doc, prepend=-1) != 0
        # a line goes on in the next one if that begins with a small letter; an end of the text without a mark may be where it was cut off
        goes_on = np.append((self.has(r"^\p{Ll}", text) & ~first & ~new_doc)[1:], False) if len(self.doc) else new_doc
        marked, last = self.has(r"[.!?\"”»][\])}]*$", text), np.append(new_doc[1:], [True] * min(1, len(self.doc))).astype(bool)
        self.ends = ~goes_on & ~(last & ~marked) & (flags(pc.utf8_length(text)) > 0)
        self.punctuated = self.ends & marked
        opens = self.has(OPENS)
        depth = np.cumsum(opens.astype(np.int64) - self.has(CLOSES))
        start = np.flatnonzero(new_doc)
        depth = depth - np.repeat(np.concatenate([[0], depth])[start], np.diff(np.append(start, len(self.doc))))
        self.table, self.listed = self.has(TABLE_LINE), self.has(LIST_LINE) | opens | (depth > 0)
        prose = ~(self.listed | self.table | self.has(MACRO_LINE))
        words, at = split(pc.utf8_split_whitespace(text))
        known = words.dictionary_encode()
        self.kinds = known.dictionary
        self.length = flags(pc.utf8_length(self.kinds)).astype(np.int64)
        codes = flags(known.indices)
        real = self.length[codes] > 0
        self.codes, at = codes[real], at[real]
        self.wdoc, self.prose = self.doc[at], prose[at]
        self.core = pc.utf8_lower(pc.replace_substring_regex(self.kinds, r"^[^\pL\pN]+|[^\pL\pN]+$", ""))


def measured_batches(common: frozenset[str], rows: int = 1000):
    """A function over Arrow batches (id, text) that gives (id, *STATISTICS)."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
            docs = len(batch)
            whole = pc.fill_null(batch.column(1), "").cast(pa.large_string())
            x = Parts(whole)
            of_kind = lambda pattern: pc.count_substring_regex(x.kinds, pattern).to_numpy(zero_copy_only=False)[x.codes]
            per = lambda owner, w=None: np.bincount(owner, weights=w, minlength=docs)
            ratio = lambda a, b: pa.array(np.divide(a, b, out=np.zeros(docs), where=b > 0), mask=b == 0)
            n, chars, n_lines = per(x.wdoc), per(x.wdoc, x.length[x.codes]), per(x.doc)
            hit = np.array([w in common for w in x.core.to_pylist()], bool)[x.codes]
            core = x.core.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)[x.codes]
            different = np.unique((x.wdoc * np.int64(len(x.kinds) + 1) + core)[hit]) // (len(x.kinds) + 1)
            line = x.lines.dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int64)
            unlike = np.unique(x.doc * np.int64(len(x.lines) + 1) + line) // (len(x.lines) + 1)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pc.utf8_length(whole).cast(pa.int64()), pa.array(n.astype(np.int64)), pa.array(n_lines.astype(np.int64)),
                    ratio(chars, n), ratio(per(x.wdoc, of_kind(r"#|\.\.\.|…")), n), ratio(per(x.wdoc, of_kind(r"\pL") > 0), n),
                    ratio(per(x.doc, x.has(BULLET)), n_lines), ratio(per(x.doc, x.has(ELLIPSIS)), n_lines), ratio(per(x.doc, x.table), n_lines), ratio(per(x.doc, x.listed), n_lines),
                    ratio(per(x.doc, x.punctuated), per(x.doc, x.ends)), ratio(n_lines - per(unlike), n_lines), *[ratio(_top_gram(x, k, docs), chars) for k in (2, 3, 4)],
                    pa.array(per(different).astype(float)), ratio(per(x.wdoc, hit), n), ratio(per(x.wdoc, hit & x.prose), chars),
                ],
                names=["id"] + [c.split()[0] for c in STATISTICS.split(", ")],
            )

    return run


def word_batches(rows: int = 1000):
    """A function over Arrow batches (id, text) that gives (id, word, n, in_prose): every document's different words, how often each comes and how often in its prose."""

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        for batch in (b.slice(at, rows) for b in batches for at in range(0, len(b), rows)):
            x = Parts(pc.fill_null(batch.column(1), "").cast(pa.large_string()))
            known = x.core.dictionary_encode()
            wide = len(known.dictionary) + 1
            pair, at = np.unique(x.wdoc * np.int64(wide) + known.indices.to_numpy(zero_copy_only=False).astype(np.int64)[x.codes], return_inverse=True)
            n, prose = np.bincount(at, minlength=len(pair)), np.bincount(at, weights=x.prose, minlength=len(pair)).astype(np.int64)
            words = known.dictionary.cast(pa.string()).take(pa.array(pair % wide))
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(pair // wide)), words, pa.array(n.astype(np.int64)), pa.array(prose)], names=["id", "word", "n", "in_prose"])

    return run


def statistics(docs: DataFrame, words: DataFrame, id_col: str = "doc_id", text_col: str = "text", task_words: int = TASK_WORDS) -> DataFrame:
    """(id, *STATISTICS): one row per document.

    A list of at most task_words common words goes to the tasks. Of a longer one nothing does: the documents' different
    words are joined with it, which gives the same numbers.
    """
    shipped(docs.sparkSession)
    kind = dict(docs.dtypes)[id_col]
    listed = words.select(F.lower("word").alias("word")).filter(F.col("word") != "").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    first = [r["word"] for r in listed.limit(task_words + 1).collect()]
    if len(first) <= task_words:
        return texts.mapInArrow(measured_batches(frozenset(first)), f"id {kind}, {STATISTICS}").withColumnRenamed("id", id_col)
    rest = texts.mapInArrow(measured_batches(frozenset()), f"id {kind}, {STATISTICS}").drop("stop_words", "common_share", "prose_common")
    hits = texts.mapInArrow(word_batches(), f"id {kind}, word string, n bigint, in_prose bigint").join(listed, "word").groupBy("id").agg(F.count(F.lit(1)).alias("hits"), F.sum("n").alias("n"), F.sum("in_prose").alias("in_prose"))
    share = lambda c, whole: F.when(F.col("n_words") > 0, F.coalesce(c, F.lit(0)) / whole)
    chars = F.round(F.col("mean_word_length") * F.col("n_words"))
    both = rest.join(hits, "id", "left").withColumns({"stop_words": F.coalesce("hits", F.lit(0)).cast("double"), "common_share": share("n", F.col("n_words")), "prose_common": share("in_prose", chars)})
    return both.drop("hits", "n", "in_prose").withColumnRenamed("id", id_col)


def _failures() -> dict:
    out = {}
    for name, (low, high) in RULES.items():
        x = F.col(name)
        bad = (x < low) if high is None else (x < low) | (x > high)
        out[name] = bad & (F.col("n_words") >= LENGTH[0]) if name in REPETITION else bad
    return out


def judged(docs: DataFrame, words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The statistics with prose_share, outside_length and reasons (names of the failed rules, in order).

    prose_share is the number of common words in prose for each character, as a part of the median of the documents that pass all published rules;
    the median is that of all these documents, within a ten-thousandth of their ranks.
    """
    stats = written(statistics(docs, words, id_col), "quality")
    some = F.col("n_words") > 0
    fails = F.array_compact(F.array(*[F.when(some & bad, F.lit(name)) for name, bad in _failures().items()]))
    stats = stats.withColumn("reasons", fails)
    listed = words.filter(F.col("word") != "").limit(1).count() > 0
    if not listed:
        stats = stats.withColumn("reasons", F.array_remove("reasons", "stop_words"))
    level = stats.filter(some & (F.size("reasons") == 0)).agg(F.percentile_approx("prose_common", F.lit(0.5), F.lit(10_000)).alias("level")).first()["level"]
    share = F.try_divide(F.col("prose_common"), F.lit(level).cast("double")) if listed else F.lit(None).cast("double")
    stats = stats.withColumns({"prose_share": share, "outside_length": some & ~F.col("n_words").between(*LENGTH)})
    return stats.withColumn("reasons", F.concat("reasons", F.array_compact(F.array(F.when(F.col("prose_share") < MAINLY, F.lit("prose_share"))))))


def not_prose(docs: DataFrame, words: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id) of the documents with a recorded reason."""
    return judged(docs, words, id_col).filter(F.size("reasons") > 0).select(id_col)
