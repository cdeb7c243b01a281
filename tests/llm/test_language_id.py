import zlib

import duckdb
from moodlake.llm import language_id as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {r.doc_id: r for r in L.identify(docs).collect()}
    truth = duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall()
    assert len(got) == len(truth)
    held = [(d, l) for d, l in truth if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, _ in held} == {d for d, r in got.items() if r.held_out}
    assert sum(got[d].lang_pred == l for d, l in held) >= 0.98 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_odd_rows(odd_docs, odd_rows, no_docs):
    got = L.identify(odd_docs).collect()
    assert len(got) == len(odd_rows) and L.identify(no_docs).count() == 0
    texts = dict(odd_rows)
    for r in got:
        if r.doc_id in (0, 1, 2, 3, 9):  # null, empty, blank, no letter
            assert (r.lang_pred, r.score) == ("und", 0.0), texts[r.doc_id]
        elif r.doc_id in range(4, 9):
            assert r.lang_pred in ("en", "fr")


def test_without_labels_all_is_unknown(odd_docs):
    from pyspark.sql import functions as F

    got = L.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}


def test_filter_has_no_false_negative_and_corrects_false_positives():
    grams = {"abc": 1, "bcd": 3, " ab": 2, "xyz": 1 << 69}
    model = L.LanguageFilter.build([f"l{i}" for i in range(70)], [1] * 70, grams)
    hits = model.hits(["ab", "xyz"])  # " ab" is in l1, "xyz" in l69 only
    assert hits[0, 1] >= 1 and hits[1, 69] >= 1
    assert model.decide(hits[1])[0] == "l69"
    assert model.cells.shape[1] == 2 and (model.false_rate < 0.01).all()


def test_rejects_only_texts_without_language(odd_docs, odd_rows):
    kept = L.keep_identified(odd_docs)
    assert kept.columns == odd_docs.columns
    gone = {i for i, _ in odd_rows} - {r.doc_id for r in kept.select("doc_id").collect()}
    assert {0, 1, 2, 3, 9} <= gone and not gone & set(range(200, 240))


class ExactSets:
    """What the filter stands for: the set of n-grams of each language, without false positives."""

    def __init__(self, rows):
        self.counts = {}
        for text, lang in rows:
            counted = self.counts.setdefault(lang, {})
            for word in L._words(text.lower()):
                for gram in L._ngrams(word):
                    counted[gram] = counted.get(gram, 0) + 1
        self.grams = {}
        for lang, counted in self.counts.items():
            least = max(2, sum(counted.values()) * L.LEAST_SHARE)
            self.grams[lang] = {g for g, n in counted.items() if n >= least}

    def shares(self, text):
        found = [g for w in L._words(text.lower()) for g in L._ngrams(w)]
        return {lang: sum(g in own for g in found) / len(found) for lang, own in self.grams.items()} if found else {}


def test_equals_exact_sets(spark):
    """Every document against the languages' n-gram sets: the score within the
    filter's chance hits, and the same language wherever the sets decide clearly."""
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text", "lang").collect()]
    learned = {(t, l) for i, t, l in rows if zlib.crc32(str(i).encode()) % 3 != 1 and t is not None and l is not None}
    sets = ExactSets(learned)
    got = {r.doc_id: r for r in L.identify(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).collect()}
    clear = 0
    for i, text, _ in rows:
        shares = sets.shares(text or "")
        if not shares:
            assert got[i].lang_pred == "und"
            continue
        best, *rest = sorted(shares.values(), reverse=True)
        assert abs(got[i].score - best) < 0.06, i
        if best - max(rest, default=0) > 0.06:
            clear += 1
            assert shares[got[i].lang_pred] == best
    assert clear > 0.9 * len(rows)


def test_copies_count_once_in_training(spark):
    """A text that is most of the rows of a language leaves the other texts' n-grams in its filter."""
    texts = [(i, f"stone river number {chr(97 + i % 26)}{chr(97 + i // 26)}", "en") for i in range(300)]
    copies = [(1000 + i, "zzz yyy xxx", "en") for i in range(3000)]
    docs = spark.createDataFrame(texts + copies, "doc_id long, text string, lang string")
    plain = L.fit(spark.createDataFrame(texts + copies[:1], "doc_id long, text string, lang string"))
    model = L.fit(docs)
    assert (model.hits(["stone", "river", "number"]) == plain.hits(["stone", "river", "number"])).all()


SAMPLES = {
    "en": "the old house by the river was sold in the spring and the new owners have planted trees along the road".split(),
    "fr": "la vieille maison pres de la riviere fut vendue au printemps et les nouveaux proprietaires ont plante des arbres".split(),
    "fi": "vanha talo joen varrella myytiin kevaalla ja uudet omistajat istuttivat puita tien varteen yksi kerrallaan hyvin hitaasti".split(),
}


def sentences(lang, n, rng):
    return [" ".join(rng.choice(SAMPLES[lang]) for _ in range(rng.randint(5, 60))) for _ in range(n)]


def test_an_unlearned_language_goes_and_learned_ones_stay(spark):
    import random

    rng = random.Random(1)
    rows = [(i, t, lang) for lang in ("en", "fr") for i, t in enumerate(sentences(lang, 200, rng), 1000 * (1 + (lang == "fr")))]
    rows += [(5000 + i, t, None) for i, t in enumerate(sentences("fi", 60, rng))]
    kept = {r.doc_id for r in L.keep_identified(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert kept == {i for i, _, lang in rows if lang}


def test_all_documents_with_a_language_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    gone = docs.join(L.keep_identified(docs).select("doc_id"), "doc_id", "left_anti").collect()
    assert not [r.doc_id for r in gone if r.text and L._words(r.text)]


def test_stage_keeps_columns_of_its_own_names_and_works_without_labels(spark, no_docs):
    rows = [(i, "the river and the stone", "en", "mine", 7.5) for i in range(10)] + [(20, "12 34", None, "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _lang_pred string, _lang_score double")
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and sorted(tuple(r) for r in kept.collect()) == rows[:-1]
    bare = docs.selectExpr("doc_id", "text", "cast(null as string) as lang", "_lang_pred", "_lang_score")
    assert {r.doc_id for r in L.keep_identified(bare).collect()} == set(range(10))
    two = L.keep_identified(docs.filter("doc_id < 2"))  # too few to learn an n-gram from
    assert two.count() == 2 and L.keep_identified(no_docs).count() == 0


def test_every_labelled_text_counts_and_sets_the_threshold(spark, monkeypatch):
    """12,180 different texts of one language: words that are in nine of them
    reach their share of all texts' n-grams, which a part of the texts would miss."""
    from string import ascii_lowercase as abc

    rare = [chr(0x3B1 + k) * 5 for k in range(20)]
    texts = [f"stone river number {abc[i // 676]}{abc[i // 26 % 26]}{abc[i % 26]}" for i in range(12000)]
    texts += [f"stone river number {w} {abc[i]}" for w in rare for i in range(9)]
    rows = [(i, t, "en") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    hits = L.fit(docs).hits(rare)
    assert (hits[:, 0] == hits[:, -1]).all()
    judged = []
    monkeypatch.setattr(L, "known_share", lambda known, *more: judged.append(known.count()) or 0.0)
    L.keep_identified(docs)
    assert judged == [sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _, _ in rows)]


def test_words_are_runs_of_letters():
    import regex

    for text in ["".join(chr(c) + "1" * (c % 3 == 0) for c in range(0x250)), "a² Ⅷ日本 x_y ·é", "", "ß µm 5ª", "İstanbul ća"]:
        assert L._words(text) == regex.findall(r"\p{L}+", text)


def test_ngrams_of_many_words_at_once(monkeypatch):
    """Windows over all words give each word's n-grams, and none across two words."""
    words = ["a", "ab", "abcab", "日本語", "\U00020000\U00020001z", "é" * 50, "aaaa", "b"]
    grams, at, owner = L._gram_places(words)
    assert len(set(grams)) == len(grams)
    for i, word in enumerate(words):
        assert sorted(grams[p] for p, o in zip(at, owner) if o == i) == sorted(L._ngrams(word))
    assert [len(x) for x in L._gram_places([])] == [0, 0, 0]
    model = L.LanguageFilter.build(["x", "y"], [1, 1], {g: 1 + i % 3 for i, g in enumerate(grams) if i % 4})
    whole, counts = model.hits(words), {"x": L.Counter(dict(zip(words, range(1, 9))))}
    monkeypatch.setattr(L, "WORDS_AT_ONCE", 3)
    assert (model.hits(words) == whole).all()
    want = L.Counter()
    for word, n in counts["x"].items():
        for gram in L._ngrams(word):
            want[gram] += n
    [batch] = L._gram_counts(counts)
    assert dict(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())) == want and not counts


def test_texts_judged_together_keep_their_own_scores(spark):
    """Long, short and empty texts in one batch, with more words than are taken at a time."""
    import random

    rng = random.Random(3)
    learned = [(i, t, lang) for lang in ("en", "fr") for i, t in enumerate(sentences(lang, 100, rng), 1000 * (1 + (lang == "fr")))]
    docs = spark.createDataFrame(learned, "doc_id long, text string, lang string")
    model = L.fit(docs)
    texts = [" ".join(rng.choice(SAMPLES[("en", "fr", "fi")[i % 3]]) + chr(97 + i % 26) * (k % 7 == 0)
                      for k in range(30_000 if i % 20 == 5 else 40)) for i in range(60)]
    texts[7], texts[8], texts[59] = None, "12 34", ""
    got = L.predict(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), model).collect()
    for r in got:
        words = L._words((texts[r.doc_id] or "").lower())
        want = model.decide(model.hits(words).sum(axis=0)) if words else ("und", 0.0)
        assert (r.lang_pred, r.score) == want
    assert len(got) == 60


def test_stage_leaves_no_copy_of_the_documents(spark):
    """What stays in the shared folder holds no texts."""
    import glob
    import os

    from moodlake.llm.common import shared_dir

    there = lambda: set(glob.glob(os.path.join(shared_dir(spark).removeprefix("file:"), "llm", "*")))
    before = there()
    docs = spark.createDataFrame([(i, f"the river and the stone {i}", "en") for i in range(50)], "doc_id long, text string, lang string")
    assert L.keep_identified(docs).count() == 50
    new = there() - before
    assert new and not any("string" in dict(spark.read.parquet(d).drop("lang").dtypes).values() for d in new)
