"""Text operators: exactness, brute force and awkward texts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from anemora.llm import bpe, contamination, quality

FILE = f"{bpe.TOKENIZERS}/byte_bpe_50k.json"
DOC = "doc_id bigint, text string, id string, ids string"


def docs(spark, texts):
    return spark.createDataFrame([(n, t, "x", "y") for n, t in enumerate(texts)], DOC)


@pytest.mark.skipif(not os.path.exists(FILE), reason="no vocabulary file")
def test_token_ids(spark):
    import tokenizers

    rng = random.Random(2)
    texts = [None, "", " ", "\n", "a", "<|endoftext|>", "x" * 30_000, " " * 500, "don't  stop\t\n\n  now \u00a0 end ", "nul\0 in it  twice"]
    texts += ["".join(rng.choice("aab \n\t'se1٣éß  \u00a0\u2028中.,\x1c\x85𝛼\u0301") for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["".join(rng.choice("etaoinshr ") for _ in range(200)) for _ in range(100)]
    t = tokenizers.Tokenizer.from_file(FILE)
    t.encode_special_tokens = True
    want = {n: e.ids for n, e in enumerate(t.encode_batch([x or "" for x in texts], add_special_tokens=False))}
    got = {r["doc_id"]: r["ids"] for r in bpe.token_ids(docs(spark, texts)).collect()}
    assert got == want
    assert bpe.token_ids(docs(spark, [])).count() == 0


ITEM = " ".join(f"{a}{b}" for a in ("glacio", "thermo", "poly", "neuro", "crysto", "vorto") for b in ("mer", "gen", "lith", "ferr", "dend", "phot", "stoch", "tens", "baric", "hydr"))
FILL = "it has been argued that the decline of the layer shows a wet process in this region over the last decade"


def test_leaked(spark):
    words = ITEM.split()
    half = " ".join(words[10:42])
    edited = [w for n, w in enumerate(words) if n % 10 != 3]
    changed = " ".join("other" if n % 10 == 3 else w for n, w in enumerate(words))
    too_many = " ".join("other" if n % 5 == 3 else w for n, w in enumerate(words))
    broken = "\n% ".join(f"\\emph{{{w}}}" for w in words[:20]) + " " + " ".join(w[:4] + "-\n" + w[4:] for w in words[20:]).upper()
    texts = [None, "", "   ", FILL, ITEM, f"{FILL} {half} {FILL}", " ".join(edited), changed, too_many, broken, " ".join(words[:20]), ITEM + " " + ITEM, f"{FILL}. " * 50 + ITEM, " ".join(reversed(words))]
    items = spark.createDataFrame([(7, ITEM, "s"), (8, None, "s"), (9, "", "s"), (10, ITEM + " 1 2 3", "s")], "item_id bigint, text string, suite string")
    got = {(r["doc_id"], r["item_id"]) for r in contamination.leaked(docs(spark, texts), items).collect()}
    assert {d for d, i in got if i == 7} == {4, 5, 6, 7, 9, 11, 12}
    assert {i for _, i in got} <= {7, 10}
    assert contamination.leaked(docs(spark, []), items).count() == 0
    assert contamination.leaked(docs(spark, texts), items.limit(0)).count() == 0


def test_accents_and_formulas(spark):
    plain = " ".join(f"élévation{n} donnée{'abcdefghij'[n % 10]} naïf{'klmnopqrst'[n // 10]}" for n in range(20))
    tex = plain.replace("é", "{\\'e}").replace("ï", '\\"{\\i}')
    tex = " $p < 0.6$ ".join(tex.split(" ")[k] for k in range(60))
    items = spark.createDataFrame([(1, plain)], "item_id bigint, text string")
    assert contamination.leaked(docs(spark, [tex, plain.replace("é", "e\u0301")]), items).count() == 2


def test_reparameterised(spark):
    """Copies, refilled templates, inconsistent refills and mere stock phrases."""
    item = "The tank near Lyon holds 3.5 km of pipe and each pipe carries 45 loads so after 45 loads the tank of 3.5 km near Lyon must be filled again by the keeper of the long pipe"
    again = item.replace("3.5", "777").replace("45", "31").replace("Lyon", "Gent").replace("km", "cm")
    mixed = again.replace("777", "779", 1)
    stock = f"{FILL} so after 45 loads the tank of 3.5 km must be found. {FILL}"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    rows = docs(spark, [item, again, mixed, stock, f"{FILL} {again} {FILL}", item.upper()])
    got = {r["doc_id"]: r["refilled"] for r in contamination.reparameterised(rows, items).collect()}
    assert got == {1: 8, 4: 8}
    assert {r["doc_id"] for r in contamination.leaked(rows, items).collect()} == {0, 5}


def test_templates():
    import pyarrow as pa

    x = contamination.Texts(pa.array(["In Mai the Rhine rose by 3.5 km per h and 12 W m2, then the Rhine fell", None, "a 1,5 kg"]))
    n, u, m = contamination.NUMBER, contamination.UNIT, contamination.NAME
    assert x.kinds.tolist() == [0, 0, 0, m, 0, 0, n, u, 0, 0, 0, n, u, u, 0, 0, m, 0, 0, n, u]
    assert x.ends.tolist() == [0, 18, 18, 21]
    german = contamination.Texts(pa.array(["die Stadt und der Fluss sah den Herrn Anton Meier und die Brücke am Abend"]))
    assert german.kinds.tolist() == [0] * 7 + [m] * 3 + [0] * 5


def test_least_windows(spark):
    rows = spark.range(1, 300).select(F.col("id").cast("int").alias("n")).select("n", contamination._least(F.col("n")).alias("least")).collect()
    assert all(r["least"] == contamination.least_windows(r["n"]) for r in rows)


def test_leaked_among_very_many_items(spark):
    """30,000 items that share a stock phrase; the windows are joined by shuffle."""
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(6))
    texts = [f"{' '.join(word() for _ in range(14))} as it has been shown in the last report on the matter {' '.join(word() for _ in range(14))}" for _ in range(30_000)]
    items = spark.createDataFrame(list(enumerate(texts)), "item_id bigint, text string")
    asked = [f"{FILL} as it has been shown in the last report on the matter {FILL}"] + [f"{FILL} {texts[n]} {FILL}" for n in (0, 17, 29_999)]
    for limit in (0, contamination.BROADCAST_WINDOWS):
        got = sorted(tuple(r) for r in contamination.leaked(docs(spark, asked), items, broadcast_windows=limit).collect())
        assert got == [(1, 0), (2, 17), (3, 29_999)]


def test_sketch_lets_every_window_through(spark):
    import numpy as np

    h = np.random.default_rng(1).integers(-(2**63), 2**63 - 1, 5000)
    for bits in (10, contamination.SKETCH_BITS):
        table = contamination.sketch(spark.createDataFrame([(int(x),) for x in h], "h bigint"), bits)
        assert len(table) == 2**bits // 8 and contamination._in_sketch(table, h, bits).all()
    other = np.random.default_rng(2).integers(-(2**63), 2**63 - 1, 5000)
    assert contamination._in_sketch(table, other).mean() < 0.01


def test_alignment_against_plain_edit_counts():
    rng = random.Random(4)
    for _ in range(30):
        item = [rng.randint(1, 50) for _ in range(rng.randint(20, 60))]
        out = list(item)
        edits = rng.randint(0, len(item) // 12)
        for k in rng.sample(range(6, len(item) - 6), edits):
            out[k] = -7
        matched, found = contamination.align([item], [[0] * 5 + out + [0] * 9])
        assert (matched[0], found[0]) == (len(item) - edits, edits)


def stretch_exists(item, doc):
    """The rule of leaked() tried on every stretch of the document and of the item, by plain tables of edits."""
    n = len(item)
    for at in range(len(item)):
        for start in range(len(doc)):
            row = {(0, 0): {0: 0}}
            for i in range(len(item) - at + 1):
                for j in range(len(doc) - start + 1):
                    here = row.setdefault((i, j), {})
                    for (p, q), gain, cost in (((i - 1, j - 1), 1, 0), ((i - 1, j - 1), 0, 1), ((i - 1, j), 0, 1), ((i, j - 1), 0, 1)):
                        if gain and (not i or not j or item[at + i - 1] != doc[start + j - 1]):
                            continue
                        for e, matched in row.get((p, q), {}).items():
                            if e + cost <= n // 7 and matched + gain > here.get(e + cost, -1):
                                here[e + cost] = matched + gain
                    if any(2 * k >= n and 8 * e <= k + e for e, k in here.items()):
                        return True
    return False


def test_leaks_against_every_stretch():
    rng = random.Random(6)
    seen = set()
    for _ in range(60):
        item = [rng.randint(1, 30) for _ in range(rng.randint(14, 18))]
        doc = item[(at := rng.randint(0, 4)) : at + rng.randint(7, 16)]
        for _ in range(rng.randint(0, 3)):
            k = rng.randrange(len(doc))
            doc[k : k + 1] = rng.choice([[0], [], [doc[k], 0]])
        docs = [[0] * rng.randint(0, 2) + doc + [0]]
        got = bool(contamination.leaks([item], docs, *contamination.align([item], docs))[0])
        assert got == stretch_exists(item, docs[0])
        seen.add(got)
    assert seen == {True, False}


def test_leaked_with_edits_at_the_ends(spark):
    words = ITEM.split()[:40]
    put = lambda text, *at: " ".join("other" if n in at else w for n, w in enumerate(text))
    spread = [w if n < 24 or n % 4 else "other" for n, w in enumerate(words)]
    texts = [put(words[:21], 2), put(words[:21], 18), put(words[:23], 2, 20), " ".join(words[:20]), " ".join(spread), put(words[:20], 2), " ".join(words[:19]), put(words[:22], 2, 19)]
    items = spark.createDataFrame([(1, " ".join(words))], "item_id bigint, text string")
    got = {r["doc_id"] for r in contamination.leaked(docs(spark, [f"{FILL} {t} {FILL}" for t in texts]), items).collect()}
    assert got == {0, 1, 2, 3, 4, 7}


PROSE = [
    "It is clear that the form of the layer in this region is wet, and that it was the cause of most of the change seen in spring. ",
    "We have to show for each model that its mean holds with a small error, which is the aim of the next section. ",
    "Over the last decade the field has been warm and the wind from the north was weak, but no one knows why it is so. ",
    "A second scale, based on the same data, gives a better view of what happens with the ice in a cold winter. ",
]


def test_quality(spark):
    listed = spark.createDataFrame([("en", w) for w in "the of and in is that it for a to have be with was The of".split()] + [("en", None), ("en", "")], "lang string, word string")
    prose = "\n\n".join("".join(PROSE[n:] + PROSE[:n]) for n in range(4))
    listing = "\\begin{document}\n" + "\n".join(f"\\item entry{n} thing" for n in range(60)) + "\nThis is the end of it."
    table = "\n".join(f"{n} & {n}.5 & 3 \\\\" for n in range(80))
    junk = "\n".join("QWxsIHlvdXIgYmFzZSBhcmUgYmVsb25nIHRv" for _ in range(40))
    bibliography = "\\begin{thebibliography}{9}\n" + "\n".join(f"\\bibitem{{a{n}}} Name, A. The form of the layer in the region. J. X, {n}." for n in range(30)) + "\n\\end{thebibliography}"
    repeated = "the wind of the north is in the ice. " * 60
    texts = [None, "", "  \n ", prose, listing, table, junk, bibliography, prose * 2 + "\n" + bibliography[:400], "\\usepackage{x}\n\\begin{document}\r\n" + prose, "x" * 200_000, "&" * 100_000, "\u00a0", "\u200b \u3000\n", "".join(PROSE).replace(" the ", " the\n"), repeated]
    assert {r["doc_id"] for r in quality.not_prose(docs(spark, texts), listed).collect()} == {4, 5, 6, 7, 10, 15}
    rows = {r["doc_id"]: r for r in quality.judged(docs(spark, texts), listed).collect()}
    assert len(rows) == len(texts)
    assert rows[0]["n_words"] == 0 and rows[0]["reasons"] == [] and rows[3]["reasons"] == [] and rows[3]["punctuated_lines"] == 1.0
    assert "bullet_lines" in rows[4]["reasons"] and "alpha_words" in rows[5]["reasons"] and "mean_word_length" in rows[6]["reasons"] and "prose_share" in rows[7]["reasons"] and "top_4gram" in rows[15]["reasons"]
    assert rows[3]["n_words"] == len(prose.split()) and rows[3]["mean_word_length"] == pytest.approx(sum(map(len, prose.split())) / len(prose.split()))
    assert rows[3]["stop_words"] == len({w.lower().strip(",.") for w in prose.split()} & set("the of and in is that it for a to have be with was".split()))
    assert quality.not_prose(docs(spark, []), listed).count() == 0
    assert "stop_words" not in {x for r in quality.judged(docs(spark, texts), listed.limit(0)).collect() for x in r["reasons"]}


def test_quality_with_a_list_too_long_for_the_tasks(spark):
    """A joined list of 6,000 words gives the same numbers as one that goes to the tasks."""
    listed = spark.createDataFrame([("en", w) for w in "the of and in is that it for a".split()] + [("en", f"word{n}") for n in range(6000)], "lang string, word string")
    texts = ["".join(PROSE), "word5 word6 The word5\n\\item the thing", None, "&&&", "Nothing here."]
    inside, joined = ({r["doc_id"]: r.asDict() for r in quality.statistics(docs(spark, texts), listed, task_words=n).collect()} for n in (10_000, 100))
    assert inside == joined and inside[1]["stop_words"] == 3 and inside[1]["common_share"] == pytest.approx(5 / 6) and inside[1]["prose_common"] == pytest.approx(4 / 26)
