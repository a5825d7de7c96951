import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from samples import docs, empty, prose, rows  # noqa: F401
from larder.llm import set_join, simhash, substring
from larder.llm.common import components


def test_simhash_groups(docs, rows):
    got = {r["doc_id"]: (f"{r['fp'][0] & (1 << 64) - 1:016x}", r["component_id"])
           for r in simhash.groups(docs, width=3).collect()}
    assert got == brute.simhash(rows)


def test_simhash_of_repeats_nulls_and_nothing(spark, docs, empty):
    assert simhash.groups(empty).count() == 0
    odd = spark.createDataFrame([(5, "x y z"), (5, "x y z"), (None, "x y z"), (None, "solo q"), (7, None)],
                                "doc_id long, text string")
    got = sorted(((r["doc_id"], r["component_id"]) for r in simhash.groups(odd).collect()), key=str)
    assert got == [(5, 5), (5, 5), (7, 7), (None, 5), (None, None)]


@pytest.mark.parametrize("large", [1024, 8])
@pytest.mark.parametrize("blocks", [simhash.Blocks(), simhash.Blocks(distance=46, words=4)])
def test_links_lose_none_within_the_distance(spark, monkeypatch, large, blocks):
    """Chains of fingerprints around one base: all in few buckets, far more than ``large``."""
    monkeypatch.setattr(simhash, "LARGE", large)
    r = np.random.default_rng(5)
    near = 2 if blocks.words == 1 else 12
    fps = [r.integers(0, 1 << 64, blocks.words, np.uint64) for _ in range(30)]
    for _ in range(170):
        flipped = fps[r.integers(0, len(fps))].copy()
        for bit in r.integers(0, 64 * blocks.words, near):
            flipped[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        fps.append(flipped)
    fps = np.unique(np.array(fps), axis=0)
    n = len(fps)
    root = np.arange(n)
    far = np.bitwise_count(fps[:, None] ^ fps[None]).sum(2)
    a, b = np.nonzero(far <= (blocks.distance if blocks.words == 1 else near))
    simhash._join(root, a, b)
    table = spark.createDataFrame([(i, [int(x) for x in f.view(np.int64)]) for i, f in enumerate(fps)],
                                  "node long, fp array<long>")
    found = {r["node"]: r["root"] for r in components(simhash.links(table, blocks), "t").collect()}
    got = np.array([found.get(i, i) for i in range(n)])
    if blocks.words == 1:
        assert (got == root).all()
    else:  # what lies nearer than the loose distance is found, and unrelated ones stay apart
        assert all(got[i] == got[j] for i, j in zip(a, b))
        assert len(set(got)) >= 25


def test_large_buckets_of_long_fingerprints_lose_no_pair(spark, monkeypatch):
    """Pairs at 39 to 46 bits that share one block, whose bucket is large: all are linked."""
    monkeypatch.setattr(simhash, "LARGE", 8)
    r, blocks, fps, pairs = np.random.default_rng(9), simhash.Blocks(distance=46, words=4), [], []
    while len(pairs) < 40:
        a = r.integers(0, 1 << 64, 4, np.uint64)
        a.view(np.uint16)[0] = 0x1234
        b = a.copy()
        for bit in r.choice(np.arange(16, 256), r.integers(39, 47), replace=False):
            b[bit // 64] ^= np.uint64(1) << np.uint64(bit % 64)
        both = blocks.keys(np.array([a, b]))
        if (both[0] == both[1]).any():
            pairs.append((len(fps), len(fps) + 1))
            fps += [a, b]
    table = spark.createDataFrame([(i, [int(x) for x in f.view(np.int64)]) for i, f in enumerate(fps)],
                                  "node long, fp array<long>")
    found = {x["node"]: x["root"] for x in components(simhash.links(table, blocks), "t").collect()}
    lost = [p for p in pairs if found.get(p[0], -1) != found.get(p[1], -2)]
    assert lost == []


def _gone(spark, texts):
    import corpus_pipeline

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    return set(range(len(texts))) - {r["doc_id"] for r in corpus_pipeline.near_copies(spark, docs, "").collect()}


def test_near_copies_are_pairs_of_the_similarity_and_no_others(spark):
    """100 shingles of which the last 11 (12) differ have a similarity of 0.802 (0.786)."""
    texts = []
    for i in range(60):
        words = [f"w{i}x{k}" for k in range(104)]
        change = 11 if i < 30 else 12
        texts += [" ".join(words), " ".join(words[:-change] + [f"v{i}x{k}" for k in range(change)])]
    assert _gone(spark, texts) == {2 * i + 1 for i in range(30)}


@pytest.mark.parametrize("a_row", [4, 0])
def test_groups_of_near_copies_equal_all_pairs(spark, monkeypatch, a_row):
    """Edited copies of two bases, some of copies, a common line, few words: as by brute force."""
    monkeypatch.setattr(set_join, "PAIRS_A_ROW", a_row)
    monkeypatch.setattr(set_join, "SAMPLE", 40)
    r, texts = np.random.default_rng(4), [prose(60, 90), prose(61, 120), "a b", "A  b", None, " "]
    for i in range(110):
        words = texts[int(r.integers(0, 2)) if i % 3 else int(r.integers(6, len(texts))) if i > 3 else 0].split()
        for at in r.integers(0, len(words), r.integers(1, 4)):
            words[at] = f"e{i}"
        texts.append(" ".join(words))
    texts += [f"{prose(300 + i, 30)} the line that all of these have in common" for i in range(20)]
    sets = [set(zip(*(w[i:] for i in range(5)))) if len(w := (t or "").lower().split()) >= 5 else {tuple(w)} - {()}
            for t in texts]
    root = np.arange(len(texts))
    a, b = np.array([(i, j) for i in range(len(sets)) for j in range(i)
                     if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])]).T
    simhash._join(root, a, b)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: x["component_id"] for x in set_join.groups(docs).collect()}
    assert got == dict(enumerate(root.tolist())) and 10 < len(set(got.values())) < len(texts) - 10


@pytest.mark.parametrize("large, forests", [(8192, 4), (16, 0), (16, 1)])
def test_near_copies_share_a_block_and_are_verified(spark, monkeypatch, large, forests):
    """Links are pairs of the similarity whose fingerprints meet in a block, whatever the rounds."""
    monkeypatch.setattr(simhash, "LARGE_VERIFIED", large)
    monkeypatch.setattr(simhash, "COUNTED", 1)
    monkeypatch.setattr(simhash, "FORESTS", forests)
    r, texts, blocks = np.random.default_rng(5), [prose(62, 90), "a b", "A  b", None, " "], simhash.Blocks(64, 4, views=6)
    for i in range(70):
        words = texts[int(r.integers(5, len(texts))) if i % 2 and i > 5 else 0].split()
        for at in r.integers(0, len(words), r.integers(1, 5)):
            words[at] = f"e{i}"
        texts.append(" ".join(words))
    sets = [set_join.shingles((t or "").encode(), 5) for t in texts]
    fps = np.array([simhash._bits(s, 4) for s in sets], np.uint64)
    keys, root, a, b = blocks.keys(fps), np.arange(len(texts)), [], []
    for i in range(len(texts)):
        for j in range(i):
            both = len(np.intersect1d(sets[i], sets[j]))
            alike = 5 * both >= 4 * (len(sets[i]) + len(sets[j]) - both)
            if alike and (keys[i] == keys[j]).any() and np.bitwise_count(fps[i] ^ fps[j]).sum() <= 64:
                a.append(i)
                b.append(j)
    simhash._join(root, np.array(a), np.array(b))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: x["component_id"] for x in simhash.groups(docs, 5, blocks, least=(4, 5)).collect()}
    assert got == dict(enumerate(root.tolist())) and 3 < len(set(got.values())) < 60


def test_near_copies_are_found_by_fingerprints(spark, monkeypatch):
    import corpus_pipeline

    texts = [(t := prose(63, 120)), t + " end", prose(64, 120)]
    assert _gone(spark, texts) == {1}
    monkeypatch.setattr(corpus_pipeline, "NEAR_BLOCKS", simhash.Blocks(distance=0, words=4))
    assert _gone(spark, [t, t + " " + prose(65, 12)]) == set()


def test_components_of_a_chain_a_star_and_a_loop(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 160)] + [(7, 7), (300, 299)]
    got = {r["node"]: r["root"] for r in components(
        spark.createDataFrame(edges, "a long, b long"), "t").collect()}
    assert {got[i] for i in range(51)} == {0} and {got[i] for i in range(100, 160)} == {100}
    assert got[300] == 299 and 7 in got


def test_repeats_are_removed(docs, rows):
    got = {r["doc_id"]: (r["n_words"], r["n_removed"], brute.sha(r["text"]))
           for r in substring.deduplicated(docs).collect()}
    assert got == brute.repeats(rows)


def test_repeats_among_near_copies(spark):
    """Many copies with edits, self-repeating texts and shared middles, small windows."""
    r = np.random.default_rng(8)
    words = [f"w{i}" for i in range(12)]
    base = list(r.choice(words, 90))
    rows = []
    for i in range(60):
        w = list(base)
        for at in r.integers(0, 90, 2):
            w[at] = str(r.choice(words))
        cut = sorted(r.integers(0, 90, 2))
        w = w[cut[0]:] + w[:cut[1]] + list(r.choice(words[:3], 20))
        rows.append((int(i * 7 % 61), " ".join(map(str, w))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], brute.sha(x["text"]))
           for x in substring.deduplicated(docs, window=9).collect()}
    assert got == brute.repeats(rows, 9)


def test_cut_leaves_clean_texts_as_they_are(spark, monkeypatch):
    """A bitmap of eight bits lets clean rows through to the join; they must not change."""
    from larder.llm import common

    monkeypatch.setattr(substring, "bitmap", lambda keys: common.bitmap(keys, 8))
    p = prose(77, 80)
    clean = {i: f"  {prose(100 + i, 30)}\n\n{prose(200 + i, 30)}\t x " for i in range(30)} | {30: None, 31: " \n"}
    rows = [*clean.items(), (50, p), (51, p + " own  words"), (52, p), (53, p + " more"), (54, "a " + p)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r["text"] for r in substring.cut(docs).collect()}
    assert got == clean | {50: p, 51: "own words", 53: "more", 54: "a"}


def test_repeats_of_one_id_null_ids_and_nothing(spark, empty):
    assert substring.deduplicated(empty).count() == 0
    p = prose(77, 80)
    docs = spark.createDataFrame([(4, p), (4, p), (None, p), (3, "x " + p), (9, None)],
                                 "doc_id long, text string")
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in substring.deduplicated(docs).collect())
    assert got == [(0, 0), (3, 0), (4, 80), (4, 80), (9, 0)]


def test_factors_seed_and_extend():
    h = np.arange(100, dtype=np.uint64)
    body = np.concatenate([[900, 901], h[10:80], [902]]).astype(np.uint64)
    assert list(substring.factors(h, body, [(40, 32), (50, 42)], 50)) == [(10, 80)]
    assert list(substring.factors(h, body, [(40, 33)], 50)) == []


def test_bitmaps_never_miss(spark):
    from larder.llm.common import bitmap, maybe_in

    keys = spark.range(1000)
    packed = bitmap(keys, 1 << 12)
    assert keys.filter(maybe_in(F.col("id"), packed)).count() == 1000
    assert spark.range(10_000, 20_000).filter(maybe_in(F.col("id"), packed)).count() < 4_000


def test_sketches_never_lose_a_shared_hash():
    r = np.random.default_rng(9)
    for n, m, both in [(0, 5, 0), (30, 28, 25), (300, 280, 260), (5_000, 4_300, 4_200), (900, 40, 40), (2_000, 2_000, 0)]:
        common = r.integers(0, 1 << 63, both, np.uint64) << np.uint64(1)
        x, y = (np.unique(np.concatenate([common, r.integers(0, 1 << 63, k - both, np.uint64) << np.uint64(1)]))
                for k in (n, m))
        most, sizes = set_join.shared_at_most(set_join.sketch(x), set_join.sketch(y))
        assert sizes == len(x) + len(y) and most >= len(np.intersect1d(x, y))
    assert 9 * most < 4 * 4_000  # unrelated sets have no room for a similarity of 0.8
    heap = np.arange(70_000, dtype=np.uint64)  # all in one place: wider counts
    assert set_join.shared_at_most(set_join.sketch(heap), set_join.sketch(heap)) == (70_000, 140_000)


def test_a_worker_that_waits_keeps_nothing(monkeypatch):
    from larder.llm import common
    trims = []
    monkeypatch.setattr(common, "_trim", trims.append)
    common.held("some cache", lambda: [0])
    trims.clear()
    batches = common.lean(iter([1, 2]))
    assert next(batches) == 1 and not common._held and trims == [0]
    assert list(batches) == [2] and trims == [0, 0]


def test_passages_take_one_document_at_a_time_apart():
    """The blocks of a whole batch never stand as Python objects at once."""
    import pyarrow as pa
    from larder.llm import substring

    class Column:
        def __init__(self, values, name):
            self.values, self.name = values, name

        def __iter__(self):
            return iter(self.values)

        def to_pylist(self):
            raise AssertionError(f"all of {self.name} at once")

    words = " ".join(f"w{i}" for i in range(60))
    kind = pa.list_(pa.struct([("block_doc", pa.int64()), ("body", pa.binary()),
                               ("seeds", pa.list_(pa.struct([("at", pa.int32()), ("there", pa.int32())])))]))
    at = int(substring.minimizers(substring.rolling(substring.word_hashes(
        substring.words_of(words.encode())), 25), 50)[0])
    columns = {"key": pa.array([7]), "doc_id": pa.array([2]), "text": pa.array([words]), "blocks": pa.array(
        [[{"block_doc": 1, "body": words.encode(), "seeds": [{"at": at, "there": at}]}]], kind)}

    class Batch:
        def column(self, name):
            return Column(list(columns[name]), name)

    out, = substring._parse([Batch()], 50)
    assert out.column("spans").to_pylist() == [[{"start": 0, "end": 60}]]
