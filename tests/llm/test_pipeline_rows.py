"""Rows of the pipeline's stages that are easily lost or changed, and the features of words."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from swipeline.llm import language, packing
from swipeline.llm.queries import tokenizer_path

SF = "/root/testdata/sf0.001"
#: Columns named as the stages name their own.
CLASH = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, size long, row_key long, taken long, keep_id long, gone boolean, several string, row string, part string, nth int, left int"


def rows():
    rng = random.Random(4)
    prose = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "eps", "zeta"]) + rng.choice("abcdefghij") for _ in range(n))
    base = prose(80)
    texts = [base, base, base, prose(60), prose(60), None, "", "12 34", "x", base + " tail"]
    out = [(i, t, "en", f"s{i % 3}", len(t or ""), "keep", 777, 5, 6, 7, True, "s", "r", "p", 1, 2) for i, t in enumerate(texts)]
    return [*out, (2, *out[2][1:-1], 9), out[3], (None, *out[4][1:])]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), CLASH).repartition(3)


def test_flat_features_are_those_of_each_word():
    rng = random.Random(1)
    cores = [bytes(rng.choice(b"abc\xc3\xa9z") for _ in range(rng.randint(1, 9))) for _ in range(500)] + [b"w" * 5000]
    lexicon = {c: rng.randrange(4) for c in cores[::3]}
    for known in (lexicon, {}):
        flat, owner = language._flat(cores, known)
        for i, core in enumerate(cores):
            h = np.array(language.features_of(core, known))
            assert sorted(flat[owner == i]) == sorted((h ^ h >> 16) & 0xFFFF)
    assert [len(x) for x in language._flat([], {})] == [0, 0]


def test_word_ids_survive_a_full_store():
    path = tokenizer_path("word_bpe_49k.json")
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["common", "word,", "Été"]) + str(rng.randrange(40) * (k % 2)) for k in range(50)) for _ in range(40)]
    small, large = packing.WordIds(path, room=10), packing.WordIds(path)
    for at in range(0, 40, 4):
        assert small.encode(texts[at : at + 4]) == large.encode(texts[at : at + 4])
        assert len(small.before) <= 10 + 4 * 50


def test_texts_between_languages_stay(spark):
    rng = random.Random(3)
    spelt = {"aa": "abcd", "bb": "efgh", "cc": "ijkl", "dd": "mnop"}
    say = lambda lang, n: " ".join("".join(rng.choice(spelt[lang]) for _ in range(5)) for _ in range(n))
    labelled = [(i, say(lang, 60), lang) for i, lang in enumerate(sorted(spelt) * 12)]
    mixed = [(100, " ".join(say(lang, 15) for lang in spelt), None), (101, None, None), (102, " 12 ? ", "aa"), (103, "", "aa")]
    docs = spark.createDataFrame(labelled + mixed, "doc_id long, text string, lang string")
    stay = sorted(r["doc_id"] for r in corpus_pipeline.language_id(spark, docs, SF).collect())
    assert stay == [*range(48), 100]
    unlabelled = docs.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert sorted(r["doc_id"] for r in corpus_pipeline.language_id(spark, unlabelled, SF).collect()) == [*range(48), 100]


def test_exact_copies_leave_one_row_unchanged(spark, table):
    best = {}
    for r in rows():
        key = (r[0] is not None, r[0] or 0)
        held = best.get(r[1] or "")
        if held is None or key > held[0] or key == held[0] and r < held[1]:
            best[r[1] or ""] = (key, r)
    got = sorted((tuple(r) for r in corpus_pipeline.exact_copies(spark, table, SF).collect()), key=str)
    assert got == sorted((r for _, r in best.values()), key=str)


def test_near_copies_leave_other_columns_alone(spark, table):
    got = corpus_pipeline.near_copies(spark, table, SF).collect()
    texts = [r["text"] or "" for r in got]
    assert len(set(texts)) == len(texts)
    assert {r["text_sha256"] for r in got} == {"keep"} and {r["size"] for r in got} == {777}
    base = rows()[0][1]
    assert [r["doc_id"] for r in got if (r["text"] or "").startswith(base)] == [0]


def test_mixture_takes_what_the_mix_takes(spark, table):
    got = corpus_pipeline.mixture(spark, table, SF)
    assert got.columns == table.columns
    held = got.collect()
    assert {(r["size"], r["row_key"], r["taken"], r["left"]) for r in held} <= {(777, 5, 6, 2), (777, 5, 6, 9)}
    whole = Counter(r[1] for r in rows())
    for r in held:
        assert r["text"] in whole or any((t or "").startswith(r["text"]) for t in whole)
        assert r["n_chars"] == len(r["text"] or "")


def test_stages_of_an_empty_table(spark, table):
    none = table.limit(0)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name


def test_odd_words_encode_alike_in_one_run():
    path = tokenizer_path("word_bpe_49k.json")
    odd = ["(a)", "don't", "x1", "é", "ß", "日本", "a\x1cb", "a b", "a\x85b", " ", "z" * 200, "!" * 200, "...", "A.", "�"]
    text = " ".join(odd + [f"w{'ab'[i % 2] * (i % 7)}{',' * (i % 3)}" for i in range(9000)])
    store = packing.WordIds(path)
    assert store.encode([text, None, "", text[:50]])[0] == b"".join(i.tobytes() for i in store._ids([text]))
    assert len(store.parts) < 60 and b"don't" in store.known


def test_one_store_serves_the_tasks_of_a_worker():
    path = tokenizer_path("word_bpe_49k.json")
    assert packing._words_of(path) is packing._words_of(path)


def test_words_are_looked_up_by_their_parts():
    path = tokenizer_path("word_bpe_49k.json")
    from tokenizers import Tokenizer

    texts = ["Haus haus, HAUS.", None, "", " \n", "Ça, ÇA... d'or «x» a|b x2 <|endoftext|> é,", "A" * 90 + "," + "!" * 90, "\x1cmuµ ßß; Haus"]
    store = packing.WordIds(path)
    assert [len(x) for x in store.encode(texts[:4])] == [20, 0, 0, 0]
    assert set(store.parts) == {"", "haus", ",", "."} and not store.known
    whole = Tokenizer.from_file(path)
    want = [np.array(whole.encode(t or "", add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert store.encode(texts) == store.encode(pa.array(["x", *texts])[1:]) == want
    assert packing.WordIds(path, room=1).encode(texts) == want and store.encode([]) == []


def test_few_words_are_spread_into_features_at_once(monkeypatch):
    held = []

    def spread(cores, lexicon, _flat=language._flat):
        held.append(len(cores))
        return _flat(cores, lexicon)

    words = {f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzabcd'[i // 100 % 10]}{'efghijklmn'[i // 1000]}" for i in range(9000)}
    model = language.train(["one two three", "uno dos tres"], ["en", "es"], rounds=2)
    monkeypatch.setattr(language, "_flat", spread)
    store = language.Words(model)
    store.learn(words | {"42"})
    assert sum(held) == 9000 and max(held) <= 4000
    assert len(store.table()) == 9000 and store.row["42"] == -1
    some = sorted(words)[::500]
    flat, owner = spread([w.encode() for w in some], model.lexicon)
    want = language._scores(model.weights, flat, owner, len(some))
    assert np.array_equal(store.table()[[store.row[w] for w in some]], want)
