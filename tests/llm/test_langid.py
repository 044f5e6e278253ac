import zlib

import numpy as np
from shopfloor.llm import langid


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    found = langid.op3_kneser_ney_language(spark, sf_dir)
    lang = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang")
    rows = found.join(lang, "doc_id").where("held_out and chars > 20").collect()
    assert len(rows) > 100
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert np.mean([r["accepted"] for r in rows]) > 0.99


def test_probabilities_sum_to_one():
    """Interpolated Kneser-Ney, spelled out for one language."""
    texts = ["the cat sat on the mat", "that hat", "a cat ate the rat"] * 3
    packed, counts = langid.grams(texts)
    assert counts.sum() == len(packed)
    model = langid.kneser_ney(["x"], {"x": np.unique(packed, return_counts=True)})
    symbols = np.arange(1 << 16, dtype=np.uint64)
    for context in [*np.unique(packed >> np.uint64(16))[:20], np.uint64(0x7A007A007A)]:
        total = model.probability((context << np.uint64(16)) | symbols).sum()
        assert abs(total - 1) < 0.02


def test_probability_equals_the_formula():
    packed, _ = langid.grams(["abab abba", "baba"])
    gram, n = np.unique(packed, return_counts=True)
    model = langid.kneser_ney(["x"], {"x": (gram, n)})

    def plain(g: int, order: int, counted: dict[int, int]) -> float:
        if order == 0:
            return 1 / langid.ALPHABET
        lower: dict[int, int] = {}
        for x in counted:
            low = x & ((1 << (16 * (order - 1))) - 1)
            lower[low] = lower.get(low, 0) + 1
        low = g & ((1 << (16 * (order - 1))) - 1)
        rest = plain(low, order - 1, lower)
        total = sum(c for x, c in counted.items() if x >> 16 == g >> 16)
        kinds = sum(1 for x in counted if x >> 16 == g >> 16)
        if not total:
            return rest
        once = sum(c == 1 for c in counted.values())
        twice = sum(c == 2 for c in counted.values())
        discount = min(max(once / max(once + 2 * twice, 1), 0.1), 0.9)
        weight = discount * kinds / total
        if order == 1:
            weight = max(weight, langid.UNIFORM_WEIGHT)
        return max(counted.get(g, 0) - discount, 0) / total + weight * rest

    counted = dict(zip(gram.tolist(), n.tolist(), strict=True))
    probes = np.concatenate([gram, gram ^ np.uint64(3), gram ^ np.uint64(1 << 20)])
    found = model.probability(probes)[:, 0]
    expected = [plain(g, langid.ORDER, counted) for g in probes.tolist()]
    assert np.allclose(found, expected, rtol=1e-4)


def test_odd_rows(make_documents, odd_rows):
    df = make_documents(odd_rows)
    found = langid.identified(df, ~langid.held_out("doc_id"), keep=df.columns).collect()
    assert len(found) == len(odd_rows)
    for r in found:
        text = r["row"]["text"]
        blank = text is None or not any(c.isalpha() for c in text)
        assert (r["lang_pred"] == "und") == blank
        assert r["accepted"] <= (not blank) and 0 <= r["score"] <= 1


def test_nothing_to_learn_and_empty(make_documents):
    df = make_documents([(1, "ein wort", None, "s"), (2, None, "de", "s")])
    found = langid.identified(df, ~langid.held_out("doc_id"), keep=["doc_id"]).collect()
    assert [(r["lang_pred"], r["score"], r["accepted"]) for r in found] == [("und", 0.0, False)] * 2
    assert langid.identified(df.where("false"), ~langid.held_out("doc_id"), keep=["doc_id"]).collect() == []


def test_gibberish_is_rejected_and_labels_are_no_input(make_documents):
    rng = np.random.default_rng(1)
    words = {"de": ["der", "und", "nicht", "haus"], "en": ["the", "and", "not", "house"]}
    rows = [
        (i + 10, " ".join(rng.choice(words[lang], 40)), lang, "s")
        for i, lang in enumerate(["de", "en"] * 150)
    ]
    odd = next(i for i in range(9000, 9100) if zlib.crc32(str(i).encode()) % 4 == 2)
    rows += [(odd, "xqzw vkjq zzxq wvkp " * 20, "en", "s"), (1, "der und nicht haus " * 10, "en", "s")]
    found = langid.identified(make_documents(rows), ~langid.held_out("doc_id"), keep=["doc_id"])
    by_id = {r["row"]["doc_id"]: r for r in found.collect()}
    assert not by_id[odd]["accepted"]
    assert by_id[1]["lang_pred"] == "de"
    assert sum(not r["accepted"] for r in by_id.values()) == 1


def test_every_language_is_learned(make_documents):
    """More languages than the largest few hundred, each of four letters of its own."""
    letters = [chr(c) for c in range(0x4E00, 0x4E00 + 4 * 300)]
    own = {f"l{i:03}": letters[4 * i : 4 * i + 4] for i in range(300)}
    rng = np.random.default_rng(6)
    rows = [
        (10 * k, "".join(rng.choice(own[lang], 60)), lang, "s")
        for k, lang in enumerate([*own] * 4)
    ]
    df = make_documents(rows)
    found = langid.identified(df, langid.F.lit(True), keep=["doc_id", "lang"]).collect()
    assert len(found) == len(rows)
    assert [r["lang_pred"] for r in found] == [r["row"]["lang"] for r in found]
    assert all(r["accepted"] for r in found)


def test_all_grams_make_the_model(make_documents, monkeypatch):
    """Rare grams count, however many there are and in whatever portions they come."""
    monkeypatch.setattr(langid, "PORTION_GRAMS", 70_000)
    rng = np.random.default_rng(7)
    texts = ["".join(map(chr, rng.integers(0x4E00, 0x4E00 + 3000, 6000))) for _ in range(40)]
    texts += [texts[0]]
    model = langid.learned(make_documents([(i, t, "zh", "s") for i, t in enumerate(texts)]), langid.F.lit(True))
    gram, n = np.unique(langid.grams(texts)[0], return_counts=True)
    assert len(gram) > 200_000
    whole = langid.kneser_ney(["zh"], {"zh": (gram, n)})
    assert model.languages == ["zh"]
    assert (model.probability(gram) == whole.probability(gram)).all()
    # Once-seen grams are there, so the discount is the one of the counts.
    once, twice = int((n == 1).sum()), int((n == 2).sum())
    discount = min(max(once / (once + 2 * twice), 0.1), 0.9)
    top = model.levels[0][-1]
    seen = gram >> np.uint64(16) == top.contexts[0]
    assert np.isclose(top.weight[0], discount * seen.sum() / n[seen].sum())


def test_letters_beyond_the_first_plane_are_letters():
    """None of them reads as a space, whatever 16 bits it folds into."""
    for letter in ("\U00010000", "\U00020060", "\U00030040", "\U0001D504"):
        assert letter.isalpha()
        _, counts = langid.grams([letter, f"{letter}a", "1 2"])
        assert counts[0] > 0 and counts[1] > 0 and counts[2] == 0
    symbols = langid._symbols()
    assert all(symbols[c] != 0x20 for c in range(0x10000, 0x110000) if chr(c).isalpha())
