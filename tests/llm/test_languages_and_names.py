"""Language identification over scripts of any size of alphabet, and stages
over tables whose columns have the names that the stages use."""

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import langid, stages

ALPHABETS = {"latin": "abcdefghijklmnopqrstuvwxyz", "greek": "αβγδεζηθικλμνξοπρστυφχψω", "cyrillic": "абвгдежзийклмнопрстуфхцчшщыьэюя",
             "han": "".join(map(chr, range(0x4E00, 0x5A00))), "hangul": "".join(map(chr, range(0xAC00, 0xB800))), "thai": "".join(map(chr, range(0xE01, 0xE2F))),
             "kana": "".join(map(chr, range(0x3041, 0x3091))), "arabic": "".join(map(chr, range(0x627, 0x64B))),
             "latin2": "abcdefghijklmnopqrstuvwxyz", "han2": "".join(map(chr, range(0x4E00, 0x5A00)))}


def corpus(seed=0, per_language=90):
    rng = np.random.default_rng(seed)
    rows = []
    for n, (lang, letters) in enumerate(ALPHABETS.items()):
        own = np.random.default_rng(100 + n)
        words = ["".join(own.choice(list(letters), own.integers(1, 4 if len(letters) > 1000 else 8))) for _ in range(400)]
        rows += [(1000 * n + i, " ".join(rng.choice(words, rng.integers(30, 120))), lang) for i in range(per_language)]
    return rows


def test_ten_scripts_are_told_apart(spark):
    docs = spark.createDataFrame(corpus(), "doc_id long, text string, lang string")
    out = langid.identify(docs, langid.train(docs), ["doc_id", "lang"]).withColumn("held", langid.held_out()).where("held").collect()
    for lang in ALPHABETS:
        own = [r for r in out if r["lang"] == lang]
        assert len(own) > 15 and np.mean([r["lang_pred"] == lang for r in own]) >= 0.95, lang


def test_many_labels(spark):
    rows = []
    for n in range(300):  # every label has letters of its own
        letters = [chr(0x4E00 + 7 * n + k) for k in range(7)]
        rng = np.random.default_rng(n)
        rows += [(10 * n + i, "".join(rng.choice(letters, 40)), f"l{n}") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = langid.train(docs)
    seen = docs.where(~langid.held_out()).select("lang").distinct().count()
    assert len(model.langs) == seen > 250
    out = langid.identify(docs.where(F.col("lang").isin(model.langs)), model, ["doc_id", "lang"]).collect()
    assert all(r["lang_pred"] == r["lang"] for r in out)


def test_an_unlearned_script_goes(spark):
    rows = corpus()
    learned = [(i, t, lang) for i, t, lang in rows if lang in ("latin", "han")]
    strange = [(i, t, None) for i, t, lang in rows if lang == "hangul"][:20]
    docs = spark.createDataFrame(learned + strange, "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in stages.known_language(spark, docs, "").collect()}
    assert kept == {i for i, _, _ in learned}


def test_transitions_equal_the_automaton():
    rng = np.random.default_rng(1)
    text = rng.integers(1, 900, 3000)
    state, symbol, to = langid.suffix_automaton(text.tolist())
    table, array = langid.Transitions(state, symbol, to, 1000, dense=0), langid.Transitions(state, symbol, to, 1000)
    assert (table.follow(state, symbol) == to).all() and array.array is not None and table.array is None
    pairs = set(zip(state.tolist(), symbol.tolist()))
    s, c = rng.integers(0, state.max() + 1, 5000), rng.integers(0, 1000, 5000)
    known = np.array([(a, b) in pairs for a, b in zip(s.tolist(), c.tolist())])
    assert ((table.follow(s, c) > 0) == known).all() and (table.follow(s, c) == array.follow(s, c)).all()


def test_stages_over_clashing_columns(spark, tmp_path):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("aeioulmnrst"), rng.integers(2, 9))) for _ in range(500)]
    text = [" ".join(rng.choice(words, 150)) for _ in range(40)]
    text[7] = text[3]
    text[11] = " ".join(text[2].split()[:70] + text[11].split()[:80])
    names = ["score", "lang_pred", "entropy", "__id", "__place", "__spans", "__text", "held", "a.b"]
    rows = [(i, t, "en", "s", len(t), *[f"{n}{i}" for n in names]) for i, t in enumerate(text)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{n}` string" for n in names))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns[5:] == names
        path = str(tmp_path / stage.__name__)
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
    out = docs.collect()
    assert sorted(r["doc_id"] for r in out) == [i for i in range(40) if i != 7]
    assert all(r[n] == f"{n}{r['doc_id']}" for r in out for n in names)
    assert next(r for r in out if r["doc_id"] == 11)["n_chars"] < len(text[11])
