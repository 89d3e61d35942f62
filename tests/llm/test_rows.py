"""Operators that judge documents one by one."""

import hashlib
import random
import re
from collections import Counter

import public_tokenizers
import pytest
from helpers import awkward, documents
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from kinweld.llm import bpe, language_id, quality_fm, quality_rules, token_counts, toxicity

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_measures(text):
    text = text or ""
    found = WORD.findall(text)
    windows = Counter(zip(found, found[1:], found[2:]))
    covered = set()
    for i, w in enumerate(zip(found, found[1:], found[2:])):
        if windows[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    n = len(found)
    failed = n < 50 or 100 * len(covered) > 50 * n
    return n, sum(map(len, found)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered), failed


def test_quality_measures(spark):
    rows = [*awkward(), (20, "a b c a b c\na b c\na b c\n\n # $ "), (21, "x " * 100), (22, "a a a a")]
    got = quality_rules.measure(documents(spark, rows)).collect()
    want = Counter((d, *base_measures(t)) for d, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got) == want
    assert not any(r["kept"] and r["base_failed"] for r in got)


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=30))
@settings(max_examples=150, deadline=None)
def test_repeated_words(found):
    assert quality_rules.repeated_words(found) == base_measures(b" ".join(found).decode())[4]


def test_quality_keep_passes_columns(spark):
    rng = random.Random(2)
    prose = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randint(2, 9))) for _ in range(300))
    docs = documents(spark, [(1, prose), (2, "ab " * 500), (3, None)], clashing=True)
    kept = quality_rules.keep(docs)
    assert kept.columns == docs.columns
    assert [r["doc_id"] for r in kept.collect()] == [1]
    assert quality_rules.keep(docs.limit(0)).count() == 0


def test_quality_of_other_scripts(spark):
    """The same prose in letters of two and three bytes is kept, and what
    repeats goes."""
    rng = random.Random(9)
    letters = "abcdefghijklmnopqrstuvwxyz"
    scripts = [str.maketrans(letters, "".join(chr(0x430 + k) for k in range(26))), str.maketrans(letters, "".join(chr(0x915 + k) for k in range(26)))]
    rows, good = [], set()
    for size in (900, 1100, 3000, 12_000):
        prose = prose_of(rng, size).lower()
        for script in scripts:
            good.add(len(rows))
            rows.append((len(rows), prose.translate(script)))
            if size >= 3000:
                rows.append((len(rows), (prose[: 4 * size // 5] + prose[3 * size // 5 : 4 * size // 5]).translate(script)))
    got = {r["doc_id"]: r for r in quality_rules.measure(documents(spark, rows)).collect()}
    assert {d for d, r in got.items() if r["kept"]} == good, {d: (r["kept"], r["ratio"], r["chunks_out"]) for d, r in got.items()}


def test_quality_limits_have_no_steps():
    table = quality_rules.Bands.whole
    for (a, low, high), (b, low2, high2) in zip(table, table[1:], strict=False):
        assert b >= 1.25 * a and abs(low2 - low) <= 0.9 and abs(high2 - high) <= 0.45 or a < 128


def prose_of(rng, size):
    """Invented prose from 50 syllables, about as dense as the given tables'."""
    syllables = ["".join(rng.choices("etaoinshrdlucmfwypvbgkjqxz", weights=range(26, 0, -1), k=rng.randint(2, 4))) for _ in range(50)]
    text = ""
    while len(text) < size:
        text += " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(rng.randint(5, 12))).capitalize() + ". "
    return text[:size]


@pytest.mark.parametrize("size", [700, 1500, 3000, 5000, 12_000, 40_000])
def test_quality_bands_reject_random_and_repetitive_text(spark, size):
    rng = random.Random(size)
    drawn = lambda letters: " ".join("".join(rng.choices(letters, k=rng.randint(4, 12))) for _ in range(size))[:size]
    prose = prose_of(rng, size)
    repetitive = prose[: 4 * size // 5] + prose[3 * size // 5 : 4 * size // 5]
    marked = " ".join(w + rng.choice(["###", "%%%", "&&&", "***"]) for w in prose.split())[:size]
    rows = [(1, prose), (2, drawn("0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")), (3, drawn("0123456789abcdef")), (4, repetitive), (5, marked)]
    got = {r["doc_id"]: r for r in quality_rules.measure(documents(spark, rows)).collect()}
    assert not any(r["base_failed"] for r in got.values())
    rejected = {d for d, r in got.items() if not r["kept"]}
    sure = {2} | ({4} if size >= 1500 else set()) | ({5} if size >= 3000 else set()) | ({3} if size >= 5000 else set())
    assert sure <= rejected and 1 not in rejected, {d: r["ratio"] for d, r in got.items()}


TRICKY = ["", "<|endoftext|>", "a<|endoftext|>b <|startoftext|>C", "it's they'LL we've 12 345", "a  b\n\n c\t\td   ", "x\xa0y\x85z \x1c q", "ÀÉÎ straße İstanbul ΣΑΣ", "日本語 text \U0001f600", "é nfc", "ĲǅŉºªµÐ²³¼", "".join(map(chr, range(1, 0x250))), "#$%&!! --- ...", "aaaa aaaaaaaa"]


@pytest.mark.parametrize("texts", [TRICKY, [t for _, t in awkward()]])
def test_bpe_equals_library(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = {r["doc_id"]: r for r in bpe.digests(bpe.apply(documents(spark, list(enumerate(texts))))).collect()}
    for k, t in enumerate(texts):
        ids = library.encode(t or "", add_special_tokens=False).ids
        assert got[k]["n_tokens"] == len(ids), t
        assert got[k]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[k]["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


@given(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_bpe_any_text(text):
    own = bpe.load(bpe.default_path())
    assert own.encode([text])[0].tolist() == own.library.encode(text, add_special_tokens=False).ids


def test_bpe_small_cache(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_BYTES", 700)
    own = bpe.Bpe(bpe.default_path())
    texts = ["the quick brown fox jumps", "over the lazy dog again and again", "the fox"]
    assert [x.tolist() for t in texts for x in own.encode([t])] == [own.library.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("texts", [TRICKY, [t for _, t in awkward()]])
def test_token_counts_equal_library(spark, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = {r["doc_id"]: r for r in token_counts.count_tokens(documents(spark, list(enumerate(texts)))).collect()}
    for k, t in enumerate(texts):
        assert (got[k]["n_bytes"], got[k]["n_tokens"]) == (len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)), t


@given(st.text(alphabet=st.characters(max_codepoint=0x24F), max_size=60))
@settings(max_examples=200, deadline=None)
def test_token_counts_any_latin_text(text):
    counts = token_counts.Counts(token_counts.default_path(), {"a": 1})
    assert counts.count([text]) == [len(counts.whole.encode(text, add_special_tokens=False).ids)]


def test_language_id(spark):
    en, de = "the cat and the other dog went with this", "der hund und die katze ging nicht mit einem"
    rows = [(k, f"{en} {k}", "en") for k in range(20)] + [(100 + k, f"{de} {k}", "de") for k in range(20)] + [(300, None, "en"), (301, "x", None)]
    docs = documents(spark, rows)
    model = language_id.fit(docs)
    assert model.languages == ["de", "en"]
    asked = documents(spark, [(1, "the dog and this other"), (2, "die katze und der einem"), (3, None), (4, "12 !"), (5, ""), (6, "the " * 50_000)], clashing=True)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language_id.identify(asked, model).collect()}
    assert [got[k][0] for k in range(1, 7)] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= s <= 1 for _, s in got.values())
    assert language_id.fit(docs.limit(0)) is None
    assert {r["lang_pred"] for r in language_id.identify(asked, None).collect()} == {"und"}


def test_language_scores_do_not_depend_on_neighbours(spark, monkeypatch):
    model = language_id.fit(documents(spark, [(1, "the cat", "en"), (2, "der hund", "de")]))
    texts = ["the hund", "", "cat", "x" * 30_000 + " der"]
    whole = model.score(texts)
    alone = [model.score([t]) for t in texts]
    assert whole[0] == [a[0][0] for a in alone]
    assert whole[1] == pytest.approx([a[1][0] for a in alone])


def labels_of(spark, rows, name):
    return spark.createDataFrame(rows, f"doc_id long, {name} int")


def test_quality_machine(spark):
    good = [(k, f"some plain words about topic {k} and nothing else to see here") for k in range(60)]
    bad = [(100 + k, f"BUY $$$ NOW ### {k} *** %%% &&& !!!") for k in range(60)]
    docs = documents(spark, [*good, *bad, *awkward()])
    labels = labels_of(spark, [(d, 1) for d, _ in good] + [(d, 0) for d, _ in bad] + [(1, None), (None, 1)], "quality")
    model = quality_fm.fit(docs, labels, "quality")
    got = [(r["doc_id"], r["score"]) for r in quality_fm.classify(docs, model).collect()]
    assert len(got) == len(good) + len(bad) + len(awkward())
    held = dict(got)
    assert min(held[d] for d, _ in good if d > 9) > 0.5 > max(held[d] for d, _ in bad)
    assert quality_fm.fit(docs, labels.limit(0), "quality") == 0.5
    assert {r["score"] for r in quality_fm.classify(docs.limit(2), 0.5).collect()} == {0.5}


def test_pairwise_identity():
    import numpy as np

    machine = quality_fm.Machine(0.3)
    at, x = np.array([1, 5, 9]), np.array([0.5, -1.0, 2.0])
    v = machine.factor[at]
    pairs = sum(x[i] * x[j] * (v[i] @ v[j]) for i in range(3) for j in range(i + 1, 3))
    assert machine.raw(at, x)[0] == pytest.approx(0.3 + pairs)


def test_toxicity(spark):
    rng = random.Random(1)
    syllables = ["the", "on", "er", "ing", "tion", "and", "re", "th", "ou", "ly"]
    make = lambda: [rng.choice(syllables) + rng.choice(syllables) for _ in range(60)]
    clean = [(k, " ".join(make())) for k in range(300)]
    toxic = []
    for k in range(90):
        found = make()
        for _ in range(4):
            found.insert(rng.randint(0, 60), rng.choice(["disgusting", "worthless"]))
        toxic.append((1000 + k, " ".join(found)))
    docs = documents(spark, [*clean, *toxic])
    model = toxicity.fit(docs, labels_of(spark, [(d, 0) for d, _ in clean[:250]] + [(d, 1) for d, _ in toxic[:70]], "toxic"), "toxic")
    got = {r["doc_id"]: r["score"] for r in toxicity.classify(docs, model).collect()}
    assert min(got[d] for d, _ in toxic[70:]) > 0.5 > max(got[d] for d, _ in clean[250:])
    odd = toxicity.classify(documents(spark, awkward(), clashing=True), model)
    assert odd.count() == len(awkward()) and all(0 <= r["score"] <= 1 for r in odd.collect())
    assert toxicity.fit(docs, labels_of(spark, [], "toxic"), "toxic") == 0.0


def test_language_id_keeps_every_language(spark, monkeypatch):
    """500 languages of one document each, and a matrix that must shrink."""
    rng = random.Random(6)
    names = [f"l{k:03d}" for k in range(500)]
    texts = {n: " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=6)) for _ in range(12)) for n in names}
    rows = [(k, texts[n], n) for k, n in enumerate(names)]
    rows += [(k, t, n) for k, t, n in rows[:50]] * 3
    model = language_id.fit(documents(spark, rows))
    assert model.languages == names and model.buckets == language_id.BUCKETS
    assert model.score([texts[n] for n in names])[0] == names
    monkeypatch.setattr(language_id, "CELLS", 1 << 20)
    assert language_id.fit(documents(spark, rows)).buckets == 2048


def test_language_id_by_force(spark):
    """Bayes over the same n-grams, letter by letter."""
    import math

    learn = [("en", "the cat and the dog"), ("en", "this other thing"), ("de", "der hund und die katze")]
    docs = documents(spark, [(k, t, n) for k, (n, t) in enumerate(learn)])
    model = language_id.fit(docs)

    def grams(text):
        codes = [32, *(ord(c.lower()[0]) if c.isalpha() else 32 for c in text), 32, 32, 32]
        out = []
        for order in (1, 2, 3):
            for i in range(len(codes) - 3):
                h = 0x811C9DC5 + order
                for k in range(order):
                    h = ((h ^ codes[i + k]) * 0x01000193) & 0xFFFFFFFF
                    h ^= h >> 15
                out.append(h % language_id.BUCKETS)
        return out

    count = {n: Counter() for n, _ in learn}
    for n, t in learn:
        count[n].update(grams(t))
    share = {n: sum(m == n for m, _ in learn) + 1 for n in count}
    for text in ("the dog", "die katze und", "x", "Über this"):
        logs = {n: math.log(share[n] / sum(share.values())) + sum(math.log((c[g] + 0.5) / (sum(c.values()) + 0.5 * language_id.BUCKETS)) for g in grams(text)) for n, c in count.items()}
        best = max(sorted(logs), key=logs.get)
        score = 1 / sum(math.exp(v - logs[best]) for v in logs.values())
        names, scores = model.score([text])
        assert names == [best] and scores[0] == pytest.approx(score)


def test_quality_last_chunk_has_its_own_band():
    rng = random.Random(4)
    judge = quality_rules.Judge()
    prose = prose_of(rng, 1024).encode()
    noise = bytes(rng.randrange(33, 127) for _ in range(900))
    assert judge.chunks_out(prose) == 0.0
    assert judge.chunks_out(prose + prose_of(rng, 600).encode()) == 0.0
    assert judge.chunks_out(prose + noise) == pytest.approx(900 / 1924)
    assert judge.chunks_out(noise) == 1.0 and judge.chunks_out(b"ab " * 250) == 1.0 and judge.chunks_out(b"") == 0.0


UNICODE = ["“curly” quotes — and dashes…", "日本語のテキスト です。", "Привет, мир! it's 12", "é x‍ y", "мир " * 400, "　wide　blank <|endoftext|> end", "ab" * 3000]


def test_token_counts_look_up_pieces_of_any_script():
    counts = token_counts.Counts(token_counts.default_path(), {"мир": 99})
    library = counts.whole
    fresh = token_counts.Counts(token_counts.default_path(), {})
    assert fresh.count(UNICODE) == [len(library.encode(t, add_special_tokens=False).ids) for t in UNICODE]
    assert " Привет" in fresh.cache or "Привет" in fresh.cache
    assert not any(len(w) > token_counts.LONG for w in fresh.cache)


@given(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=["Cs"]), max_size=60))
@settings(max_examples=200, deadline=None)
def test_token_counts_any_text(text):
    counts = token_counts.Counts(token_counts.default_path(), {})
    assert counts.count([text]) == [len(counts.whole.encode(text, add_special_tokens=False).ids)]


def test_token_counts_small_cache(monkeypatch):
    monkeypatch.setattr(token_counts, "CACHE_BYTES", 900)
    counts = token_counts.Counts(token_counts.default_path(), {})
    for text in UNICODE * 2:
        assert counts.count([text]) == [len(counts.whole.encode(text, add_special_tokens=False).ids)]
    assert counts.held <= 900 or len(counts.cache) <= 10_000


@pytest.mark.parametrize("texts", [UNICODE])
def test_bpe_any_script(texts):
    own = bpe.Bpe(bpe.default_path())
    assert [x.tolist() for x in own.encode(texts)] == [own.library.encode(t, add_special_tokens=False).ids for t in texts]


def test_toxicity_gains_are_compressed_lengths():
    """Dictionaries of each class's own text; gains recomputed one by one."""
    rng = random.Random(5)
    common = ["".join(rng.choices("etaoinshr", k=5)) for _ in range(25)]
    clean = [toxicity.words_of(" ".join(rng.choices(common, k=150))) for _ in range(400)]
    toxic = [toxicity.words_of(" ".join(rng.choices([*common, "disgusting", "worthless"], k=150))) for _ in range(300)]
    rows = [(k, w, y) for y, texts in ((0, clean), (1, toxic)) for k, w in enumerate(texts, 1000 * y)]
    model = toxicity.learn(rows)
    assert len(model["pairs"]) == toxicity.FOLDS
    for ordinary, bad in model["pairs"]:
        assert b"sgust" not in ordinary and b"worth" not in ordinary and ordinary[: -len(toxicity.FILLER)] not in bad
    asked = toxicity.words_of("disgusting " + " ".join(common[:20]) + " zzz worthless x")
    found = toxicity.Gains(model["pairs"]).describe(asked)
    for k, pair in enumerate(model["pairs"]):
        own = [toxicity.Gains.compressor(c) for c in pair]
        sizes = [[len(c.compress(b" " + w + b" " + toxicity.FILLER)) for w in asked] for c in own]
        gains = [max(0, min(toxicity.TOP, a - b)) for a, b in zip(*sizes, strict=True)]
        assert gains[0] + gains[-2] >= 2
        for t in range(1, toxicity.TOP + 1):
            assert found[k][toxicity.TOP + t - 1] == pytest.approx(10 * sum(g >= t for g in gains) / len(gains))
        assert found[k][-1] == max(gains) / 10
    scores = toxicity.scores(model, toxicity.Gains(model["pairs"]), ["", " ".join(common), "so disgusting and worthless"])
    assert scores[1] < 0.5 < scores[2]


def test_toxicity_repeated_ids(spark):
    """Every copy of one id counts once in what is learned."""
    from kinweld.llm import sampling

    docs = documents(spark, [(1, "a")] * 50 + [(1, "b")] * 50 + [(2, "c")])
    sample, counts = sampling.labelled(labels_of(spark, [(1, 1), (1, 0), (2, 0), (3, 1), (None, 1)], "toxic"), "toxic", 10)
    found = sampling.texts_of(docs, sample)
    assert found.columns == ["doc_id", "text", "label"] and found.count() == 2 and counts == {0: 2, 1: 2}
