import brute
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from samples import docs, empty, prose, rows, texts  # noqa: F401
from larder.llm import chat, hash_forest, hyper_language, shards, templates


def test_neighbours_reach_the_recall(spark):
    r = np.random.default_rng(1)
    v = r.standard_normal((1500, 32)).astype(np.float32)
    v[700:] = v[:800] + 0.4 * r.standard_normal((800, 32)).astype(np.float32)
    v[40:60] = v[40]  # ties
    table = spark.createDataFrame([(int(i), [float(y) for y in x]) for i, x in enumerate(v)],
                                  "vec_id long, embedding array<float>")
    got = {}
    for x in hash_forest.neighbours(table, F.col("vec_id") % 20 == 0, rows_a_block=400,
                                    queries_a_block=30).collect():
        got.setdefault(x["query_id"], {})[x["rank"]] = (x["vec_id"], x["score"])
    want = brute.neighbours(range(1500), v.astype(float))
    assert set(got) == set(want)
    hit = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q].values()}) for q in want)
    assert hit >= 0.9 * 20 * len(want)
    for q, ranks in got.items():
        assert list(sorted(ranks)) == list(range(1, 21))
        order = [ranks[k] for k in sorted(ranks)]
        assert order == sorted(order, key=lambda x: (-x[1], x[0]))
        for i, score in order:
            assert score == pytest.approx(float(v[q].astype(float) @ v[i].astype(float)), abs=1e-12)
    ties = [i for _, (i, _) in sorted(got[40].items()) if 40 < i < 60]
    assert ties == list(range(41, 41 + len(ties)))


def test_neighbours_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (4, [nan, 1.0]), (5, [inf, 1.0]),
            (6, [None, 1.0]), (7, []), (None, [1.0, 1.0]), (8, [1.0, 1.0, 1.0]), (1, [0.5, 0.5]), (20, [1.0, 0.0])]
    table = spark.createDataFrame([r + ("x",) for r in rows],
                                  "vec_id long, embedding array<double>, dims string")
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in
                 hash_forest.neighbours(table, F.col("vec_id") % 20 == 0).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 1, 0.5), (20, 1, 0, 1.0), (20, 2, 1, 0.5)]
    assert hash_forest.neighbours(table.filter("vec_id < 0"), F.col("vec_id") % 20 == 0).count() == 0


ITEMS = ["A train leaves Boston at 60 km per hour and reaches Denver after 5 hours of steady travel on its track.",
         "Name the gas that green plants take from the air when they make sugar in bright sunlight.",
         "Short seven word question about nothing here."]


def _found(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(list(enumerate(ITEMS)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]): r for r in
            templates.matches(docs, bench, **options).collect()}


def test_items_are_found_word_for_word_and_with_other_values(spark):
    lead, tail = "Some words come first and then this: ", " and after it more words follow."
    again = ITEMS[0].replace("Boston", "Lisbon").replace("60", "85").replace("5 hours", "7 hours")
    mixed = again.replace("Denver", "Lisbon").replace("85", "85")
    got = _found(spark, [lead + ITEMS[0] + tail, lead + again + tail, ITEMS[1].upper(),
                         "\n".join(ITEMS[1].split()), ITEMS[2] + tail, lead + tail, None, "",
                         "green plants take from the air", mixed])
    assert {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)} <= set(got)
    assert {d for d, _ in got} <= {0, 1, 2, 3, 4, 9}
    assert got[0, 0]["changed"] == 0 and got[1, 0]["changed"] > 0 and got[0, 0]["coverage"] > 0.9


def test_slots_must_agree(spark):
    item = "Ann gives Bob 3 apples while Bob gives Cid 3 pears so Cid and Ann have how many fruits with Bob left"
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    same = item.replace("Bob", "Eve").replace("3", "9")
    mixed = "Ann gives Eve 4 apples while Dan gives Kim 9 pears so Joe and Sue have how many fruits with Max left"
    docs = spark.createDataFrame([(1, same), (2, mixed)], "doc_id long, text string")
    got = {r["doc_id"]: r["windows"] for r in templates.matches(docs, bench, fixed=3, coverage=0).collect()}
    assert got[1] > got.get(2, 0)


def _asked(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in templates.matches(docs, bench).collect()}


def test_items_dense_with_slots_are_found(spark):
    items = ["What is 12 times 7", "add 3 and 4 to 5", "the sums 3 5 7 9 11 13 15 17 of 2 4 6 8 then double 10 12 14 16 "
             "18 and give these all back", "x 1 2 3 4 5 6 7 8 9 10 then carry on here with the rest now"]
    lead = "some words come first and then "
    wider = items[2].replace("3 5 7", "31 51 71").replace("18", "181")
    clean = lead + "9 10 then carry on here with nobody"
    got = _asked(spark, items, [lead + i + " and more follow" for i in items] + [lead + wider + " end", clean, "7 12"])
    assert got == {(0, 0), (1, 1), (2, 2), (3, 3), (4, 2)}


def test_an_item_asked_twice_with_other_values_is_found(spark):
    item = "she buys 5 red pens and then 3 blue pens on one day so tell us how many pens are hers"
    both = [item.replace("5", a).replace("3", b) for a, b in (("5", "3"), ("9", "2"))]
    assert _asked(spark, [item], [" and also ".join(both), both[1] + " again " + both[1].replace("9", "1")]) == {
        (0, 0), (1, 0)}
    short = "give 5 pens or 3 to her now"
    assert _asked(spark, [short], ["give 5 pens or 3 to her now and give 9 pens or 2 to her now"]) == {(0, 0)}


def test_names_at_sentence_starts_are_slots(spark):
    item = "Alice has 3 apples. Bob has 5 apples. How many do they have?"
    again = item.replace("Alice", "Maria").replace("Bob", "Tom")
    swapped = again.replace("3", "8").replace("5", "4")
    assert _asked(spark, [item], [again, "Some text. " + swapped, "How many do they have? Tom has apples."]) == {
        (0, 0), (1, 0)}


def test_templates_type_their_slots():
    tokens, slots = templates.canonical("He paid 3 dollars and 5% to Anna. Anna left. HE said two km")
    assert [tokens[i] for i, _ in slots] == ["\x01number", "\x02unit", "\x01number", "\x02unit", "\x03name",
                                             "\x01number", "\x02unit"]
    assert "he" in tokens and "anna" in tokens


def test_decontamination_keeps_columns_and_clean_rows(spark, docs, empty):
    bench = spark.createDataFrame([(0, dict(texts())[1]), (None, "x y"), (2, None)],
                                  "item_id long, text string")
    kept = templates.decontaminated(docs, bench)
    assert kept.columns == docs.columns
    assert {1, 2} & {r["doc_id"] for r in kept.collect()} == set()
    assert {0, 6, 7, 21} <= {r["doc_id"] for r in kept.collect()}
    assert templates.decontaminated(empty, bench).count() == 0
    assert templates.decontaminated(docs, bench.filter("item_id > 5")).count() == docs.count()


CHAT = [(1, 0, "system", "be kind"), (1, 1, "user", "### User: </turn> \\ \\\\###"), (1, 2, "assistant", "a </turn>\n"),
        (2, 0, "assistant", "first"), (3, 0, "user", None), (3, 1, "assistant", ""), (4, 1, "user", "x"),
        (4, 0, "user", "y"), (5, 0, None, "no role"), (6, 0, "user", "é" * 50_000), (6, 1, "assistant", "$1 \\1"),
        (7, 0, "user", "tie"), (7, 0, "user", "tie"), (8, 0, "tool ### x", "odd"), (9, 0, "user", "ends early")]


def test_chat_reads_back(spark):
    table = spark.createDataFrame([r + (1, "x") for r in CHAT],
                                  "conv_id long, turn long, role string, text string, place int, segments string")
    back = {r["conv_id"]: r for r in chat.read_back(chat.documents(chat.segments(table))).collect()}
    want = brute.turns([(c, t, r or "", x or "") for c, t, r, x in CHAT])
    for r in chat.digest(chat.read_back(chat.documents(chat.segments(table)))).collect():
        assert (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) == want[r["conv_id"]]
    assert [c for c in sorted(back) if back[c]["valid"]] == [1, 3, 6]
    assert back[1]["formatted"].count("\\### User") == 1
    marks = back[1]["formatted"].replace("\\\\", "").replace("\\###", "").replace("\\</turn>", "")
    assert marks.count("</turn>") == 3 and marks.count("### ") == 3
    assert chat.segments(table.filter("conv_id < 0")).count() == 0


def test_another_template(spark):
    t = chat.Template(after={"": ("q",), "q": ("a",), "a": ("q", "a")}, last=("a", "q"), before="<{role}>",
                      behind="</>", learned=("a", "q"), control=("<", ">"), escape="%")
    table = spark.createDataFrame([(1, 0, "q", "1 < 2 % 3"), (1, 1, "a", "%<"), (1, 2, "a", "ok")],
                                  "conv_id long, turn long, role string, text string")
    r = chat.read_back(chat.documents(chat.segments(table, t)), t).first()
    assert r["valid"] and [tuple(x) for x in r["turns"]] == [("q", "1 < 2 % 3"), ("a", "%<"), ("a", "ok")]
    assert r["learned"] == ["1 < 2 % 3", "%<", "ok"]


def test_languages_are_told_apart(spark):
    folder = "/root/testdata/sf0.01/documents.parquet"
    try:
        rows = pq.read_table(folder).to_pylist()
    except OSError:
        pytest.skip("no test tables")
    docs = spark.createDataFrame([(r["doc_id"], r["text"], r["lang"]) for r in rows],
                                 "doc_id long, text string, lang string")
    model = hyper_language.fit(docs.filter("doc_id % 3 <> 1"))
    said = docs.filter("doc_id % 3 = 1").select("lang", hyper_language.predict(F.col("text"), model).alias("p"))
    assert said.filter("lang = p.lang_pred").count() >= 0.97 * said.count()
    one = hyper_language.fit(docs.filter("doc_id % 3 <> 1"), most=100)
    assert set(one.languages) <= {"en", "fr", "de", "es"}


def test_languages_of_odd_texts(spark, docs, empty):
    known = docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "a").when(F.col("doc_id") < 30, "b"))
    model = hyper_language.fit(known)
    said = {r["doc_id"]: r["p"] for r in known.select(
        "doc_id", hyper_language.predict(F.col("text"), model).alias("p")).collect()}
    assert {d for d, p in said.items() if p["lang_pred"] == "und"} == {6, 7, 8}
    assert all(0 <= p["score"] <= 1 for p in said.values())
    none = hyper_language.fit(empty.withColumn("lang", F.lit("x")))
    assert docs.select(hyper_language.predict(F.col("text"), none).alias("p")).filter(
        "p.lang_pred <> 'und'").count() == 0


def test_unlearned_languages_go_and_short_clean_texts_stay(spark):
    import random

    import corpus_pipeline
    from samples import prose

    def script(low, high, seed):
        r = random.Random(seed)
        return " ".join("".join(chr(r.randint(low, high)) for _ in range(r.randint(2, 7))) for _ in range(60))

    known = [(i, prose(400 + i, 120), "a") for i in range(30)]
    short = [(100 + i, t, None) for i, t in enumerate(["Ok.", "Wxq.", "Zyz vuw.", "Qs tv", "Xyz wvu qst."])]
    foreign = [(200 + i, script(low, high, i), None) for i in range(20)
               for low, high in [((0x3B1, 0x3C9), (0x430, 0x44F), (0x5D0, 0x5EA))[i % 3]]]
    docs = spark.createDataFrame([*known, *short, *foreign, (300, "12 - 3", None)],
                                 "doc_id long, text string, lang string")
    left = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, "").collect()}
    assert left == {d for d, _, _ in known + short}
    nothing = docs.withColumn("lang", F.lit(None).cast("string"))
    assert corpus_pipeline.language(spark, nothing, "").count() == docs.count()


def test_rolled_products_tell_order_apart():
    s = hyper_language.Space(1024, 7)
    a, b = s.profile("abcabcabc"), s.profile("cbacbacba")
    assert abs(float(a @ b)) < 0.5 and float(a @ s.profile("abc abcabc")) > 0.5


@pytest.mark.parametrize("range_rows", [200_000, 3])
def test_shards_are_even_and_slots_gapless(docs, rows, range_rows):
    got = shards.shards(docs, 8, range_rows=range_rows).toPandas()
    assert sorted(got.doc_id) == [d for d, _ in rows]
    total = got["size"].sum()
    assert total == sum(len((t or "").encode()) + 1 for _, t in rows)
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
        assert abs(part["size"].sum() - total / 8) <= total / 8 * 0.01 + got["size"].max()


def test_a_hot_group_is_cut_and_small_groups_are_not(spark, empty):
    rows = [(i, "hot text") for i in range(600)] + [(i, f"text {i // 2}") for i in range(600, 1200)]
    rows += [(None, "hot text")] * 50
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    got = shards.shards(docs, 8, range_rows=40).toPandas()
    assert len(got) == 1250
    assert got.groupby("shard")["size"].sum().max() <= got["size"].sum() / 8 * 1.03
    assert got.groupby("text_crc32").shard.nunique().sort_values().iloc[-2] <= 2
    for _, part in got.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    assert shards.shards(empty).count() == 0


def test_number_signs_and_marks_are_no_letters():
    space = hyper_language.Space(64, 1)
    for text in ("² ½ ①", "Ⅷ", "12 ³", "́ ́", "_", "…", None, ""):
        assert space.trigrams(text) is None
    assert len(space.trigrams("हिन्दी")[0]) == len("हिन्दी")  # marks stay with their letters
    assert space.trigrams("Été 2²")[0].tolist() == space.trigrams("été")[0].tolist()


def test_the_language_bar_follows_the_evidence(spark):
    """Unlearned texts go more surely the longer they are; clean ones stay at every length."""
    learned = spark.createDataFrame([(prose(i, 60), "xx") for i in range(100)], "text string, lang string")
    model = hyper_language.fit(learned)
    r = np.random.default_rng(4)
    noise = lambda n: "".join(chr(c) for c in r.integers(0x4e00, 0x9000, n))
    table = spark.createDataFrame([(n, k, t) for n in (5, 36, 44, 400) for k in range(30) for t in (
        prose(1000 + k, 100)[:n], noise(n)) if t.strip()], "n int, k int, text string")
    clean = F.col("text").rlike("[a-z]")
    kept = {(x["n"], x["clean"]): x["kept"] for x in table.groupBy("n", clean.alias("clean")).agg(
        F.avg(hyper_language.learned(F.col("text"), model).cast("int")).alias("kept")).collect()}
    assert all(kept[n, True] == 1 for n in (5, 36, 44, 400))
    assert kept[5, False] == 1 and kept[400, False] == 0
    assert abs(kept[36, False] - kept[44, False]) < 0.5  # no step at any length


def test_templates_cut_as_the_pattern_does():
    """Odd characters too, whose lower case is longer or depends on what follows."""
    for text in ("1.2.3 and 1..2 or 1:2, a'b'c 'd", "ΛΟΓΟΣ λόγος ΣΑΣ İstanbul is İn", "x² ² ½ ٣ km 5 KM two\nAnn"):
        tokens, slots = templates.canonical(text, frozenset(["ann"]))
        words = [w.lower() for w in templates._TOKEN.findall(text) if w[0] not in ".!?\n"]
        values = dict(slots)
        assert [values.get(i, t) for i, t in enumerate(tokens)] == words
    known = templates._Words(frozenset())
    hashes = [templates._template(t, known)[2] for t in ("ΛΟΓΟΣ İX the", "λογος i̇x The", "λογοσ ix THE")]
    assert hashes[0][0] == hashes[1][0] != hashes[2][0] and hashes[0][-1] == hashes[1][-1] == hashes[2][-1]


def test_templates_look_at_characters_not_at_each_word(monkeypatch):
    """A word that never came before costs no Python call of its own."""
    import sys
    known, calls = templates._Words(frozenset()), [0]

    def count(frame, event, arg):
        calls[0] += event in ("call", "c_call")

    text = " ".join(f"w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{chr(97 + i // 100)}x" for i in range(2000))
    sys.setprofile(count)
    try:
        assert len(templates._template(text, known)[2]) == 2000
    finally:
        sys.setprofile(None)
    assert calls[0] < 500
