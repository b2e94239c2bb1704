from __future__ import annotations

import random
import zlib

import numpy as np
import pytest
from public_tokenizers import path
from pyspark.sql import functions as F

from llm_fixtures import make, scratch  # noqa: F401  (fixtures)

from tideline.llm import language, quality, toxicity
from tideline.llm.words import split_words

PIECES = path("piece_bpe_32k.model")


def held(doc_id: int) -> bool:
    return zlib.crc32(str(doc_id).encode()) % 4 == 2


def _labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.fixture(scope="module")
def corpus():
    words = random.Random(4)
    plain = ["river", "stone", "walk", "garden", "music", "letter", "table", "cloud", "winter", "bread"]
    rows, labels = [], []
    for k in range(400):
        text = [words.choice(plain) for _ in range(60)]
        toxic = k % 6 == 0
        if toxic:
            for _ in range(4):
                text.insert(words.randrange(len(text)), "vilegrub!")
        rows.append((k, " ".join(text)))
        if k % 5 != 3:
            labels.append((k, 1, int(toxic)))
    return rows, labels


def test_toxicity_learns_and_leaves_clean_text(spark, make, corpus):
    rows, labels = corpus
    extra = [(None, None), (9000, ""), (9001, "river " * 20_000), (9002, "!!! ???")]
    docs = make(rows + extra + rows[:2]).withColumn("toxicity", F.lit("clash"))
    settings = toxicity.Settings(bits=16, l1=2.0, shard_docs=200)
    model = toxicity.train(docs, _labels(spark, [*labels, labels[0], (77_777, 1, 1), (None, 1, 1)]), settings)
    assert 0 < len(model[0]) < 1 << 12
    scored = toxicity.with_toxicity(docs, model, settings).collect()
    assert len(scored) == len(rows) + len(extra) + 2
    for r in scored:
        assert 0 <= r["toxicity"] <= 1
        bad = r["text"] is not None and "vilegrub" in r["text"]
        assert (r["toxicity"] >= settings.threshold) == bad, r["doc_id"]
    assert sum(held(r["doc_id"]) and r["toxicity"] >= 0.3 for r in scored if r["doc_id"] is not None) > 10


def test_labels_of_the_held_out_fold_are_not_used(spark, make, corpus):
    rows, labels = corpus
    settings = toxicity.Settings(bits=14, l1=2.0)
    wrong = [(d, q, 1 - t if held(d) else t) for d, q, t in labels]
    first, second = (toxicity.train(make(rows), _labels(spark, x), settings) for x in (labels, wrong))
    assert np.array_equal(first[0], second[0]) and np.array_equal(first[1], second[1])


def test_toxicity_does_not_depend_on_the_length_of_texts(spark, make, corpus):
    rows, labels = corpus
    settings = toxicity.Settings(bits=14, l1=2.0)
    docs = make(rows)
    padded = docs.withColumn("text", F.concat("text", F.repeat(F.lit(" "), F.lit(400_000))))
    first, second = (toxicity.train(x, _labels(spark, labels), settings) for x in (docs, padded))
    assert np.array_equal(first[0], second[0]) and np.array_equal(first[1], second[1])


def test_packed_features_are_read_back():
    pick = np.random.default_rng(1)
    for n in (0, 1, 100, 511, 512, 513, 9_000, 1 << 14):
        places = np.sort(pick.permutation(1 << 14)[:n]).astype(np.int32)
        packed = toxicity._packed(places, 14)
        assert len(packed) <= 1 << 11 and np.array_equal(toxicity._unpacked(packed, 14), places)


def test_nothing_is_toxic_without_labels(spark, make):
    docs = make([(1, "some text")])
    model = toxicity.train(docs, _labels(spark, []))
    assert toxicity.with_toxicity(docs, model).first()["toxicity"] < 1e-6
    assert toxicity.with_toxicity(make([]), model).count() == 0


def _counts(text):
    text = text or ""
    words = [w for w in __import__("re").findall(r"[^\x20\x09-\x0D]+", text)]
    lines = [x for x in text.split("\n") if any(c not in " \t\n\x0b\x0c\r" for c in x)]
    windows = [tuple(words[k : k + 3]) for k in range(len(words) - 2)]
    again = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)


ODD_TEXTS = [
    None, "", " \n\t", "a b c a b c a b c", "x\n x\nx\n\n\ny\nx", "a\x1cb c\xa0d e", "é#*$ %&|<> €", "a a a a a a", "one two", "\x0b\x0c\r w \x0b",
    "p q r s p q r t " * 30, "üñ " * 100,
]


def test_counts_are_those_of_a_plain_count(spark, make):
    docs = make(list(enumerate(ODD_TEXTS))).withColumn("kept", F.lit("clash"))
    judged = {r["doc_id"]: r for r in quality.with_quality(docs, np.zeros(1 << 16)).collect()}
    for k, text in enumerate(ODD_TEXTS):
        r = judged[k]
        n, _, _, _, repeats = expected = _counts(text)
        assert tuple(r[c] for c in quality.COUNTS) == expected, text
        assert r["base_failed"] == (n < 50 or 100 * repeats > 50 * n) and r["kept"] == (not r["base_failed"])
        assert len(split_words(text)) == n


def test_quality_ratio_parts_junk_from_clean(spark, make):
    words = random.Random(2)
    syllables = ["ta", "ri", "mo", "len", "sha", "ke"]
    word = lambda: "".join(words.choice(syllables) for _ in range(3))
    rows, labels = [], []
    for k in range(200):
        junk = k % 3 == 0
        rows.append((k, " ".join(word() + ("%%%" if junk else "") for _ in range(80))))
        labels.append((k, 0 if junk else 1, 0))
    docs = make(rows)
    settings = quality.Settings(prior=10_000.0)
    ratios = quality.fit(docs, _labels(spark, labels[:120] + labels[:1]), settings)
    for r in quality.with_quality(docs, ratios).collect():
        assert r["kept"] == (r["doc_id"] % 3 != 0)
    assert np.allclose(quality.fit(docs, _labels(spark, [])), 0)
    assert quality.with_quality(make([]), ratios).count() == 0


def test_quality_counts_every_trusted_document(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.concat(F.lit("ab "), F.col("id").cast("string")).alias("text"))
    labels = docs.select("doc_id", (F.col("doc_id") < 25_000).cast("int").alias("quality"))
    nameless = docs.limit(50).select(F.lit(None).cast("long").alias("doc_id"), "text")
    settings = quality.Settings(prior=10.0)
    texts = [f"ab {k}" for k in range(30_000)]
    trusted, owner = quality._grams(texts, settings)
    target = np.bincount(trusted[owner < 25_000], minlength=1 << 16)
    raw = np.bincount(np.concatenate([trusted, quality._grams([r["text"] for r in nameless.collect()], settings)[0]]), minlength=1 << 16)
    seen = np.flatnonzero(raw)
    share = raw[seen] / raw.sum()
    want = np.zeros(1 << 16)
    want[seen] = np.log((target[seen] + settings.prior * share) / (target.sum() + settings.prior)) - np.log(share)
    assert np.allclose(quality.fit(docs.unionByName(nameless), labels, settings), want)


def _probability(word, lattice, column):
    """Sum over all segmentations, by trying each."""
    marked = "▁" + word

    def rest(at):
        if at == len(marked):
            return 1.0
        total = 0.0
        for end in range(at + 1, len(marked) + 1):
            piece = lattice.vocab.get(marked[at:end])
            if piece is not None:
                total += column[piece] * rest(end)
        if lattice.vocab.get(marked[at]) is None:
            total += column[-1] * rest(at + 1)
        return total

    return rest(0)


def test_forward_sums_all_segmentations():
    lattice = language._lattice(PIECES, 10)
    random_ = np.random.default_rng(3)
    table = random_.random((lattice.size + 1, 2)) * 1e-3
    words = ["the", "naïve", "ωμέγα", "a", "straße", "reading", "漢字"]
    found = language.log_probabilities(words, lattice, table)
    for k, word in enumerate(words):
        for j in range(2):
            assert np.isclose(found[k, j], np.log(_probability(word, lattice, table[:, j])))
    assert np.isfinite(language.log_probabilities(["ab" * 3000], lattice, table)).all()


def test_long_pieces_and_long_runs_count(spark, make, scratch):
    lattice = language._lattice(PIECES)
    assert "▁information" in lattice.vocab and lattice.longest == max(map(len, lattice.vocab))
    column = np.random.default_rng(4).random((lattice.size + 1, 1)) * 1e-3
    for word in ("information", "especially", "straightforward"):
        assert np.isclose(language.log_probabilities([word], lattice, column)[0, 0], np.log(_probability(word, lattice, column[:, 0])))
    assert np.isclose(language.log_probabilities(["ꙮ" * 900], lattice, np.full_like(column, 1e-7))[0, 0], np.log(_probability("", lattice, np.full(lattice.size + 1, 1e-7))) + 900 * np.log(1e-7))
    # Expected counts of a long run are those of finite differences of its log probability.
    words = ["theinformationofthegovernment" * 4, "the", "ꙮ" * 100]
    table = np.repeat(column, 2, axis=1)
    found = language._expected(words, np.array([2.0, 1.0, 1.0]), np.array([0, 0, 1]), lattice, table)
    for piece in (lattice.vocab["▁the"], lattice.vocab["information"], lattice.vocab["the"]) if "information" in lattice.vocab else (lattice.vocab["▁the"], lattice.vocab["the"]):
        more = table.copy()
        more[piece] *= 1 + 1e-6
        slope = (language.log_probabilities(words, lattice, more) - language.log_probabilities(words, lattice, table))[:, 0] / 1e-6
        assert np.isclose(found[piece, 0], 2 * slope[0] + slope[1], rtol=1e-3)
    assert np.isclose(found[-1, 1], 100)
    pick = random.Random(3)
    runs = {"xa": "badalukato", "xb": "mirenosive"}
    run = lambda lang: "".join(pick.choices(runs[lang], k=70))
    rows = [(k, " ".join(run(lang) for _ in range(3)), lang) for k, lang in enumerate(list(runs) * 30)]
    model = language.train(make(rows), PIECES, scratch)
    for r in language.with_language(make(rows), model, PIECES).collect():
        assert r["lang_pred"] == r["lang"] and r["score"] > 0.99


def test_language_of_held_out_texts(spark, make, scratch):
    said = {
        "en": "the ship went over the water with all the people who had waited there",
        "de": "das schiff fuhr über das wasser mit allen leuten die dort gewartet hatten",
        "fr": "le bateau est allé sur la mer avec tous les gens qui avaient attendu",
    }
    words = random.Random(8)
    rows = [(k, " ".join(words.sample(said[lang].split(), 9)), lang) for k, lang in enumerate(list(said) * 40)]
    rows += [(500, None, "en"), (501, "", "de"), (502, "12 + 34 = !!", "fr"), (503, "wasser", None), (None, "la mer", "fr"), (504, "the " * 30_000, "en")]
    docs = make(rows + rows[:1])
    model = language.train(docs, PIECES, scratch)
    assert model.languages == ["de", "en", "fr"]
    got = language.with_language(docs.withColumn("score", F.lit("clash")), model, PIECES).collect()
    assert len(got) == len(rows) + 1
    for r in got:
        assert 0 <= r["score"] <= 1
        if r["doc_id"] in (500, 501, 502):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        elif r["lang"] is not None:
            assert r["lang_pred"] == r["lang"]
    nothing = language.train(make([(1, "text", None)]), PIECES, f"{scratch}-2")
    assert language.with_language(make([(1, "text", None)]), nothing, PIECES).first()["lang_pred"] == "und"


_LONG = (1 << 64) - 1


def _plain_places(text, bits):
    """Places of a text's features, one feature after another."""
    odd, mix = int(toxicity._ODD), int(toxicity._MIX)
    bare = [toxicity._EDGE.sub("", w.lower()) for w in split_words(text)]
    h = [__import__("xxhash").xxh3_64_intdigest(b) for b in bare if b]

    def joined(a, b, kind):
        z = ((a * mix + b) * odd + kind) & _LONG
        return ((z ^ (z >> 32)) * odd) & _LONG

    found = list(h)
    for k in range(len(h)):
        if k + 1 < len(h):
            pair = joined(h[k], h[k + 1], 1)
            found.append(pair)
            if k + 2 < len(h):
                found += [joined(pair, h[k + 2], 2), joined(h[k], h[k + 2], 3)]
            if k + 3 < len(h):
                found.append(joined(h[k], h[k + 3], 4))
    return sorted({((f * odd) & _LONG) >> (64 - bits) for f in found})


def _plain_ftrl(examples, s):
    """FTRL-proximal by coordinate, in dictionaries; the constant is the place 2 ** bits."""
    z, n = {}, {}

    def weight(i):
        shrink = 0.0 if i == 1 << s.bits else s.l1
        if abs(z.get(i, 0.0)) <= shrink:
            return 0.0
        return ((shrink if z[i] > 0 else -shrink) - z[i]) / ((s.beta + n[i] ** 0.5) / s.alpha + s.l2)

    order = np.random.default_rng(7)
    for _ in range(s.epochs):
        for k in order.permutation(len(examples)):
            places, label = examples[k]
            x = [*places, 1 << s.bits]
            w = [weight(i) for i in x]
            g = 1 / (1 + np.exp(-max(-35.0, min(35.0, sum(w))))) - label
            for i, wi in zip(x, w, strict=True):
                before = n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - ((before + g * g) ** 0.5 - before**0.5) / s.alpha * wi
                n[i] = before + g * g
    return {i: weight(i) for i in z if weight(i)}


def test_toxicity_equals_a_plain_version(spark, make):
    pick = random.Random(12)
    words = ["Good", "day,", "you", "awful", "(fool)", "sun", "é", "...", "SEA"]
    rows = [(k, " ".join(pick.choices(words, k=pick.randrange(9)))) for k in range(120)] + [(500, None), (501, ""), (502, "..."), (503, "fool " * 5_000), (503, "sun day")]
    labels = [(k, 1, int("fool" in (t or ""))) for k, t in rows if k < 100 and k != 7] + [(7, 1, 1), (7, 1, 0), (8, 1, 5), (9, 1, None)]
    s = toxicity.Settings(bits=12, l1=0.5, shard_docs=10_000)
    places, weights, share = toxicity.train(make(rows), _labels(spark, labels), s)
    known = {}
    for k, _, t in labels:
        if t in (0, 1) and not held(k):
            known[k] = max(t, known.get(k, 0))
    examples = [(_plain_places(t or "", s.bits), known[k]) for k, t in sorted(((k, t) for k, t in rows if k in known), key=lambda r: r[0])]
    expected = _plain_ftrl(examples, s)
    assert np.isclose(share, sum(y for _, y in examples) / len(examples))
    assert dict(zip(places.tolist(), np.round(weights, 9).tolist(), strict=True)) == {i: round(w, 9) for i, w in expected.items()}
    scored = toxicity.with_toxicity(make(rows).withColumn("toxicity", F.lit("clash")), (places, weights, share), s).collect()
    assert len(scored) == len(rows)
    for r in scored:
        bare = [w for w in split_words(r["text"] or "") if toxicity._EDGE.sub("", w.lower())]
        total = sum(expected.get(i, 0.0) for i in _plain_places(r["text"] or "", s.bits)) + expected.get(1 << s.bits, 0.0)
        assert np.isclose(r["toxicity"], 1 / (1 + np.exp(-total)) if bare else share)


def _segmentations(word, lattice):
    """All ways to cut a word with its mark into pieces; a letter that is no piece stands alone."""
    def cut(rest):
        if not rest:
            yield []
        for n in range(1, len(rest) + 1):
            piece = lattice.vocab.get(rest[:n])
            if piece is None and n == 1:
                piece = lattice.size
            if piece is not None:
                for others in cut(rest[n:]):
                    yield [piece, *others]

    return list(cut(language._MARK + word))


def test_language_equals_a_plain_version(spark, make, scratch):
    pick = random.Random(21)
    said = {"en": ["the", "sea", "ships", "and"], "de": ["das", "meer", "und", "ß"], "xx": ["ꙮa", "sea", "de"]}
    rows = [(k, " ".join(pick.choices(said[lang], k=6)).title() + ". 12", lang) for k, lang in enumerate(list(said) * 20)] + [(900, None, "en"), (901, "the", None)]
    lattice, s = language._lattice(PIECES), language.Settings()
    model = language.train(make(rows), PIECES, scratch, s)
    names = sorted(said)
    used = [r for r in rows if not held(r[0]) and r[1] is not None and r[2] is not None]
    table = np.full((lattice.size + 1, 3), 1.0 / lattice.size)
    for _ in range(s.passes):
        table[-1] = s.unknown
        total = np.zeros_like(table)
        for _, text, lang in used:
            j = names.index(lang)
            for word in language._LETTERS.findall(text.lower()):
                ways = _segmentations(word, lattice)
                chances = [np.prod(table[way, j]) for way in ways]
                for way, chance in zip(ways, chances, strict=True):
                    for piece in way:
                        total[piece, j] += chance / sum(chances)
        total = total[:-1] + s.smoothing
        table = np.vstack([total / total.sum(axis=0), np.full((1, 3), s.unknown)])
    assert model.languages == names and np.allclose(model.table, table, rtol=1e-9)
    priors = np.log([sum(r[2] == name for r in rows if r[1] is not None and not held(r[0])) / len(used) for name in names])
    assert np.allclose(model.priors, priors)
    for r in language.with_language(make(rows), model, PIECES).collect():
        if r["text"] is None:
            assert r["lang_pred"] == "und"
            continue
        logs = priors.copy()
        for word in language._LETTERS.findall(r["text"].lower()):
            logs += np.log([sum(np.prod(table[way, j]) for way in _segmentations(word, lattice)) for j in range(3)])
        chances = np.exp(logs - logs.max())
        assert r["lang_pred"] == names[int(logs.argmax())] and np.isclose(r["score"], chances.max() / chances.sum())
