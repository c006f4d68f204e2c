import random

import numpy as np
import pytest
import xxhash
from llm.edge_cases import DOCUMENT, TEXTS, clashing, documents, empty, prose
from pyspark.sql import functions as F

from geolink.llm import components, simhash


def slow_fingerprint(text, shingle=4):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    grams = [b" ".join(words[i : i + shingle]) for i in range(max(len(words) - shingle + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


class Sets:
    def __init__(self, items):
        self.parent = {i: i for i in items}

    def root(self, a):
        while self.parent[a] != a:
            a = self.parent[a]
        return a

    def join(self, a, b):
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)


def brute_components(prints):
    """Smallest id in reach, by all pairs."""
    sets = Sets(prints)
    ids = sorted(prints)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (prints[a] ^ prints[b]).bit_count() <= 4:
                sets.join(a, b)
    return {i: sets.root(i) for i in ids}


@pytest.mark.parametrize("text", [t for _, t in TEXTS if t is None or len(t) < 20_000])
def test_fingerprint(text):
    assert simhash.fingerprint(text and text.encode()) == slow_fingerprint(text)


def test_keys_meet_within_four_bits():
    rng = np.random.default_rng(0)
    x = rng.integers(-(2**63), 2**63, 3000, dtype=np.int64)
    for errors in range(5):
        y = x.copy()
        for row in range(len(y)):
            for bit in rng.choice(64, errors, replace=False):
                y[row] ^= np.int64(1) << np.int64(bit)
        (at, key, filed), (other, wanted, filed_too) = simhash.keys_of(x), simhash.keys_of(y)
        mine = dict(zip(zip(at.tolist(), key.tolist(), strict=True), filed.tolist(), strict=True))
        met = {
            p
            for p, k, f in zip(other.tolist(), wanted.tolist(), filed_too.tolist(), strict=True)
            if (p, k) in mine and (f or mine[p, k])
        }
        assert met == set(range(len(x)))


def test_code_is_perfect():
    remainder, leader = simhash._leaders()
    assert len(np.unique(leader)) == 2048 and np.bitwise_count(leader).max() == 3
    assert (remainder[leader] == np.arange(2048)).all()


def chain(spark, count, seed, copies=2):
    """Fingerprints in chains of small steps, and others far from all."""
    rng = random.Random(seed)
    found = []
    while len(found) < count:
        fp = rng.getrandbits(64)
        for _ in range(rng.randint(1, 6)):
            found.append(fp)
            for bit in rng.sample(range(64), rng.randint(0, 6)):
                fp ^= 1 << bit
    return found


@pytest.mark.parametrize("block", [2048, 3])
def test_components_of_fingerprints(spark, block):
    prints = list(dict.fromkeys(chain(spark, 400, 7)))
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    distinct = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    links = simhash.fingerprint_links(distinct, block=block)
    roots = {r.node: r.root for r in components.connected_components(links, "u", "v").collect()}
    expected = brute_components(dict(zip(signed, prints, strict=True)))
    assert {p: roots.get(p, p) for p in signed} == expected


def test_rows_of_the_table(spark):
    rows = simhash.component_table(clashing(spark)).collect()
    prints = {}
    for i, t in TEXTS:
        prints.setdefault((i is None, i or 0, slow_fingerprint(t)), None)
    assert len(rows) == len(TEXTS)
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].component_id == by_id[3].component_id == by_id[4].component_id == 2
    assert by_id[2].fingerprint == "0" * 16 and by_id[6].component_id == 5
    assert by_id[8].component_id == 7 and by_id[None].component_id == -1
    assert simhash.component_table(empty(spark)).count() == 0


def test_near_copies_go_and_others_stay(spark):
    """Against all pairs of fingerprints, with edits that lie on both sides of four bits."""
    rng = random.Random(9)
    base = [prose(600).split() for _ in range(30)]
    texts = [(i, " ".join(w)) for i, w in enumerate(base)]
    for i, words in enumerate(base):
        texts.append((100 + i, " ".join([*words, *prose(1 + i // 3).split()])))
        words = list(words)
        words[rng.randrange(600)] = "edited"
        texts.append((200 + i, " ".join(words)))
        texts.append((300 + i, " ".join(base[i]).upper()))
    expected = brute_components({i: slow_fingerprint(t) for i, t in texts})
    kept = {r.doc_id for r in simhash.drop_near_copies(documents(spark, texts)).collect()}
    assert kept == {i for i, first in expected.items() if i == first}
    assert set(range(30)) <= kept and 0 < len(kept & set(range(100, 300))) < 60
    assert not kept & set(range(300, 330))


def test_one_of_repeated_rows_stays_whatever_their_order(spark):
    rows = [(1, "same text", "en", f"s{i}", i) for i in range(20)]
    found = set()
    for part in (rows, rows[::-1], rows[7:] + rows[:7]):
        kept = simhash.drop_near_copies(spark.createDataFrame(part, DOCUMENT).repartition(3)).collect()
        found |= {tuple(r) for r in kept}
        assert len(kept) == 1
    assert len(found) == 1


def test_ids_that_are_texts(spark):
    docs = documents(spark, [(i, t) for i, t in TEXTS if i is not None])
    docs = docs.withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    kept = {r.doc_id for r in simhash.drop_near_copies(docs).collect()}
    assert {"d1", "d5", "d7"} <= kept and not {"d6", "d8"} & kept


def test_dropping_keeps_columns_and_one_row_for_repeats(spark):
    docs = clashing(spark)
    kept = simhash.drop_near_copies(docs)
    assert kept.columns == docs.columns
    # A row without an id and one with the id -1 are one where the text is.
    ids = sorted((-1 if r.doc_id is None else r.doc_id for r in kept.collect()), key=str)
    assert ids == sorted([1, 2, 5, 7, 9, 10, 11, -1, 12, 13, 14, 15], key=str)
    assert simhash.drop_near_copies(empty(spark)).count() == 0


@pytest.mark.parametrize("count", [0, 1, 60])
def test_connected_components(spark, count):
    rng = random.Random(count)
    edges = [(rng.randrange(80) - 40, rng.randrange(80) - 40) for _ in range(count)]
    edges += [(i, i + 1) for i in range(100, 100 + count)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    sets = Sets({n for e in edges for n in e})
    for a, b in edges:
        sets.join(a, b)
    found = {r.node: r.root for r in components.connected_components(df, "a", "b").collect()}
    assert all(found.get(n, n) == sets.root(n) for n in sets.parent)
    assert all(sets.root(n) != n for n in found)


def test_star_of_one_node_contracts():
    u, v = components.contracted(np.full(1000, 5), np.arange(1000) + 6)
    assert (v == 5).all() and len(u) == 1000


def test_schema_has_the_columns_of_the_contract(spark):
    df = simhash.component_table(documents(spark))
    assert df.schema.simpleString() == "struct<doc_id:bigint,fingerprint:string,component_id:bigint>"
    assert df.filter(F.length("fingerprint") != 16).count() == 0
    assert DOCUMENT.startswith("doc_id")


def test_groups_without_ids_or_of_one_id_stay_apart(spark):
    texts = [(None, prose(60)) for _ in range(4)] + [(7, prose(60)) for _ in range(3)]
    copies = [(None, texts[0][1].upper()), (7, texts[5][1].upper()), (8, texts[6][1].upper())]
    kept = simhash.drop_near_copies(documents(spark, texts + copies)).collect()
    assert sorted(r.text.lower() for r in kept) == sorted(t for _, t in texts)
    assert not any(r.doc_id == 8 for r in kept)
