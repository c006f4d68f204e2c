import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.edge_cases import TEXTS, clashing, documents, empty, prose

from geolink.llm import ngram_lm, queries
from geolink.llm.elias_fano import EliasFano


def tokens(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [*low.encode().split(), None]


def brute(train, texts, least=1, discount=0.75):
    """Token counts, base score and model score of each text, by plain counting."""
    words, pairs = Counter(), Counter()
    for text in train:
        t = tokens(text)
        words.update(t)
        pairs.update(zip(["start", *t[:-1]], t, strict=True))
    total, distinct = sum(words.values()), len(words)
    seen, taken = Counter(), Counter()
    for (h, _), n in pairs.items():
        seen[h] += n
        taken[h] += n - discount if n >= least else 0
    out = []
    for text in texts:
        t, base, score = tokens(text), 0.0, 0.0
        for h, w in zip(["start", *t[:-1]], t, strict=True):
            p = (words[w] + 1) / (total + distinct + 1)
            base += math.log10(p)
            if seen[h]:
                n = pairs[h, w]
                p = (1 - taken[h] / seen[h]) * p + ((n - discount) / seen[h] if n >= least else 0)
            score += math.log10(p)
        out.append((len(t), sum(words[w] > 0 for w in t), base, score))
    return total, out


def check(found, expected):
    assert found[:2] == expected[:2]
    assert found[2] == pytest.approx(expected[2], rel=1e-9)
    assert found[3] == pytest.approx(expected[3], abs=2e-4 * expected[0])


@pytest.mark.parametrize(("shard", "chunk", "least"), [(1_000_000, 1_000_000, 1), (7, 5, 1), (40, 1, 1), (7, 50, 2)])
def test_scores_against_counting(spark, monkeypatch, shard, chunk, least):
    monkeypatch.setattr(ngram_lm, "SHARD", shard)
    monkeypatch.setattr(ngram_lm, "CHUNK", chunk)
    rng = random.Random(1)
    texts = [(i, " ".join(rng.choice("a b c D d ee F".split()) for _ in range(rng.randint(0, 30)))) for i in range(70)]
    held = {i for i, _ in texts if zlib.crc32(str(i).encode()) % 7 == 2}
    total, expected = brute([t for i, t in texts if i not in held], [t for _, t in texts], least)
    rows = {r.doc_id: r for r in ngram_lm.score_table(documents(spark, texts), least=least).collect()}
    assert {i for i, r in rows.items() if r.held_out} == held
    for (i, _), e in zip(texts, expected, strict=True):
        r = rows[i]
        assert r.train_tokens == total
        check((r.n_tokens, r.n_known, r.base_score, r.score), e)


def test_edge_cases(spark):
    docs = clashing(spark)
    rows = ngram_lm.score_table(docs).collect()
    train = [t for i, t in TEXTS if zlib.crc32(("" if i is None else str(i)).encode()) % 7 != 2]
    _, expected = brute(train, [t for _, t in TEXTS])
    found = sorted((r.n_tokens, r.n_known, r.base_score, r.score) for r in rows)
    assert len(found) == len(TEXTS)
    for f, e in zip(found, sorted(expected), strict=True):
        check(f, e)


def test_empty_tables(spark):
    assert ngram_lm.score_table(empty(spark)).count() == 0
    model = ngram_lm.train(empty(spark))
    row = ngram_lm.score_texts(documents(spark, [(1, "a b")]), model, "text").first()
    assert (row.n_tokens, row.n_known, row.base_score, row.score) == (3, 0, 0.0, 0.0)


def test_probabilities_of_a_context_add_up_to_one(spark):
    texts = [(i, prose(30)) for i in range(40)]
    model = ngram_lm.train(documents(spark, texts))
    known = np.sort(np.array(list({ngram_lm.token_hash(w) for _, t in texts for w in t.encode().split()} | {ngram_lm.END})))
    ids, counts = ngram_lm.find_tokens(model, known)
    below = np.log10((counts + 1) / (model.total + model.distinct + 1))
    unknown = math.log10(1 / (model.total + model.distinct + 1))
    for context in [0, 5, model.start]:
        word = np.append(ids, -1)
        p = 10 ** ngram_lm.score_bigrams(model, np.full(len(word), context), word, np.append(below, unknown))
        assert p.sum() == pytest.approx(1, abs=2e-3)


def test_cuts_of_contexts():
    for counts, limit in (([5], 2), ([1] * 10, 3), ([0, 9, 1, 1, 1, 20, 0, 2], 4), ([3, 3], 100)):
        found = np.array(ngram_lm.cuts(np.array(counts), limit)).reshape(-1, 3)
        assert found[0, 0] == 0
        firsts = sorted((p + k / parts, p, k, parts) for p, k, parts in found.tolist())
        for (_, p, _, parts), nxt in zip(firsts, [*firsts[1:], (None, len(counts), 0, 1)], strict=True):
            assert parts == (-(-counts[int(p)] // limit) if counts[int(p)] > limit else 1)
            if parts == 1:
                assert sum(counts[int(p) : int(nxt[1])]) <= 2 * limit


def test_counts_are_added_up_in_between():
    rng = np.random.default_rng(2)
    sums, expected = ngram_lm.Sums(50), Counter()
    for _ in range(40):
        keys, counts = np.unique(rng.integers(0, 300, 30), return_counts=True)
        sums.add(keys, counts)
        expected.update(dict(zip(keys.tolist(), counts.tolist(), strict=True)))
    keys, counts = sums.total()
    assert dict(zip(keys.tolist(), counts.tolist(), strict=True)) == expected and (np.diff(keys) > 0).all()
    keys = np.array([0, 1, 2**40, 2**62])
    assert [a.tolist() for a in ngram_lm.unpacked_run(ngram_lm.packed_run(keys, keys % 7 + 1))] == [keys.tolist(), (keys % 7 + 1).tolist()]


def test_the_folder_must_be_mounted():
    with pytest.raises(RuntimeError, match="mounted"):
        ngram_lm._local("hdfs://host/checkpoints")


@pytest.mark.parametrize(("size", "top"), [(1, 1), (2, 2**63), (500, 40), (3000, 10**6), (3000, 2**64 - 1)])
def test_elias_fano(size, top):
    rng = np.random.default_rng(size)
    values = np.sort(rng.integers(0, top, size, dtype=np.uint64))
    sequence = EliasFano.build(values)
    assert (sequence.access(np.arange(size)) == values).all()
    asked = np.concatenate([values, rng.integers(0, top, 500, dtype=np.uint64), np.array([0, top - 1], np.uint64)])
    begin, end = np.zeros(len(asked), np.int64), np.full(len(asked), size)
    found = sequence.find(asked, begin, end)
    known = set(values.tolist())
    for value, at in zip(asked.tolist(), found.tolist(), strict=True):
        assert (at >= 0) == (value in known) and (at < 0 or int(values[at]) == value)
    half = sequence.find(values, np.full(size, size // 2), np.full(size, size))
    assert all((at >= size // 2) == (v in set(values[size // 2 :].tolist())) for v, at in zip(values.tolist(), half.tolist(), strict=True))


def test_the_query_stores_bigrams_seen_once(spark, tmp_path):
    texts = [(i, prose(12)) for i in range(40)]
    documents(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    train = [t for i, t in texts if zlib.crc32(str(i).encode()) % 7 != 2]
    _, expected = brute(train, [t for _, t in texts], least=1)
    rows = {r.doc_id: r for r in queries.op10_lm_scoring(spark, str(tmp_path)).collect()}
    for (i, _), e in zip(texts, expected, strict=True):
        r = rows[i]
        check((r.n_tokens, r.n_known, r.base_score, r.score), e)
