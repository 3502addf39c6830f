"""Perplexity, line quality and language: held-out accuracy, laws of the models, and odd rows."""

from __future__ import annotations

import os
import re
import subprocess
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from docketry.llm import langid, linecrf, perplexity

from .conftest import prose


def brute_metrics(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(inside)


def test_metrics(odd_rows):
    repeated = "a b c d e f g h " * 2 + "i j k " + "q r s t u v w x " * 3
    for text in [t for _, t, *_ in odd_rows] + [repeated, "a " * 30, "x\nx\n\n\nx y", "# * $ % & | < >", "w" * 10_000]:
        assert perplexity.text_metrics(text) == brute_metrics(text)


def test_hash_array():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 63, 5000, np.uint64))
    table = perplexity.HashArray(keys, np.arange(1, len(keys) + 1))
    assert (table.find(keys, -1.0) == np.arange(1, len(keys) + 1)).all()
    assert (table.find(keys + np.uint64(1), -1.0) == np.where(np.isin(keys + np.uint64(1), keys), 0, -1)).mean() > 0.99
    none = perplexity.HashArray(keys[:0], keys[:0])
    assert none.find(keys[:3], 0.5).tolist() == [0.5] * 3


def test_probabilities_add_up(make_docs):
    """After any context the probabilities of all symbols add up to one."""
    rows = [(i, prose(30, i), "en", "a") for i in range(30)]
    model = perplexity.fit(make_docs(rows).select("text"))
    symbols = np.arange(0, 1 << 16, dtype=np.uint64)
    alphabet = {int(k) & 0xFFFF for t in rows for part in perplexity.gram_keys(t[1]) for k in part}
    for context in ("alp", "zzz", "qqq", " ga"):
        base = np.uint64(0)
        for c in context:
            base = (base << np.uint64(16)) | np.uint64(ord(c))
        p = np.exp(model.log_probability((base << np.uint64(16)) | symbols))
        assert p[sorted(alphabet)].sum() == pytest.approx(1.0, abs=0.02)


def brute_kneser_ney(texts):
    """Log probability of symbol tuples by interpolated modified Kneser-Ney, straight from its definition."""
    n, raw = perplexity.ORDER, Counter()
    for t in texts:
        symbols = [1] * (n - 1) + perplexity.symbols_of(t).tolist() + [2]
        raw.update(tuple(symbols[i : i + n]) for i in range(len(symbols) - n + 1))
    counts = {n: raw}
    for order in range(n - 1, 0, -1):
        above, here = counts[order + 1], Counter()
        for gram, times in above.items():
            here[gram[1:]] += times if gram[1] == 1 else 1
        counts[order] = here
    cuts = {o: perplexity.discounts(Counter(c.values())) for o, c in counts.items()}

    def probability(gram):
        if not gram:
            return 1.0 / len(counts[1])
        here = counts[len(gram)]
        after = {g: c for g, c in here.items() if g[:-1] == gram[:-1]}
        if not after:
            return probability(gram[1:])
        total, cut = sum(after.values()), cuts[len(gram)]
        left = sum(cut[min(c, 3) - 1] for c in after.values()) / total
        c = after.get(gram, 0)
        return (max(c - cut[min(c, 3) - 1], 0) / total if c else 0.0) + left * probability(gram[1:])

    return probability


def test_model_equals_its_definition(make_docs):
    texts = ["abab abba", "abba cab", "abc", "b ab ab", "cabbage", "ab", "ab", "the cab", "a bad cab bed"]
    model = perplexity.fit(make_docs([(i, t, "en", "a") for i, t in enumerate(texts)]).select("text"))
    probability = brute_kneser_ney(texts)
    for t in [*texts, "bead", "zab"]:
        for keys in perplexity.gram_keys(t):
            want = [np.log(probability(tuple((int(k) >> s) & 0xFFFF for s in (48, 32, 16, 0)))) for k in keys]
            known = [i for i, k in enumerate(keys) if chr(int(k) & 0xFFFF) != "z"]
            assert model.log_probability(keys)[known] == pytest.approx(np.array(want)[known], rel=1e-4)


def test_too_many_ngrams_are_refused(make_docs):
    with pytest.raises(ValueError, match="distinct n-grams"):
        perplexity.fit(make_docs([(1, prose(50, 1), "en", "a")]).select("text"), 20)


def test_bands_on_the_labelled_documents(spark):
    """On the given tables: most of the documents that are labelled good and pass the base rule stay, and some of the bad go."""
    sf_dir = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = perplexity.judge(docs.select("doc_id", "text", "lang")).where("not base_failed").join(labels, "doc_id").collect()
    good, bad = ([r["kept"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert np.mean(good) >= 0.985 and np.mean(bad) <= 0.75


def test_clashing_names(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    clash = docs.selectExpr("*", *[f"'y' as {c}" for c in ("low", "high", "band_lang", "log_perplexity", "base_failed", "n_words")])
    got = perplexity.judge(clash).drop("band_lang").collect()
    assert sorted(map(str, got)) == sorted(map(str, perplexity.judge(docs).select(perplexity.judge(clash).drop("band_lang").columns).collect()))


def test_the_model_grows_with_the_texts(make_docs):
    """More than two million distinct n-grams are all kept."""
    points = np.random.default_rng(3).integers(0x4E00, 0x9FA5, (8, 280_000))
    rows = [(i, "".join(map(chr, p)), "zh", "a") for i, p in enumerate(points.tolist())]
    known = len(np.unique(np.concatenate([part for r in rows for part in perplexity.gram_keys(r[1])])))
    assert known > 2_200_000
    assert len(perplexity.fit(make_docs(rows).select("text")).probabilities[perplexity.ORDER].hashes) == known


def test_counts_equal_brute_force(make_docs, odd_rows):
    want = Counter()
    for _, t, *_ in odd_rows:
        for part in perplexity.gram_keys(t or ""):
            want.update(part.view(np.int64).tolist())
    got = {r["key"]: r["n"] for r in perplexity.count_grams(make_docs(odd_rows).select("text")).collect()}
    assert got == dict(want)


def test_pieces_hold_the_same_grams(monkeypatch):
    text = prose(200, 3)
    whole = np.concatenate(list(perplexity.gram_keys(text)))
    monkeypatch.setattr(perplexity, "_PIECE", 50)
    assert (np.concatenate(list(perplexity.gram_keys(text))) == whole).all()


def test_bands_reject_the_strange_and_keep_the_clean(make_docs, odd_rows):
    clean = [(1000 + i, prose(80, i), ("en", "de")[i % 2], "a") for i in range(120)]
    strange = [(5000 + i, " ".join(f"#{i}${j}%&|{chr(0x4E00 + 37 * i + j)}" for j in range(40)), "en", "a") for i in range(4)]
    got = {}
    for r in perplexity.judge(make_docs(clean + strange + odd_rows)).collect():
        got.setdefault(r["doc_id"], []).append(r)
    assert all(got[i][0]["kept"] for i, *_ in clean)
    assert not any(got[i][0]["kept"] for i, *_ in strange) and not any(got[i][0]["base_failed"] for i, *_ in strange)
    for i, t, *_ in odd_rows:
        m = brute_metrics(t)
        failed = m[0] < 20 or 100 * m[4] > 30 * m[0]
        assert any(tuple(r[x] for x in perplexity.METRICS) == m and r["base_failed"] == failed and not (failed and r["kept"]) for r in got[i])
    assert sum(map(len, got.values())) == len(clean + strange + odd_rows)


def test_no_documents(make_docs):
    empty = make_docs([])
    assert perplexity.judge(empty).count() == 0
    assert langid.identify(empty, langid.fit(empty.select("text", "lang"))).count() == 0
    assert linecrf.score(empty, linecrf.fit(empty.select(F.col("doc_id").alias("id"), "text", F.lit(1).alias("label")))).count() == 0


# --- quality -----------------------------------------------------------------------------------


def bad_line(seed):
    return (prose(8, seed).upper().replace(" ", "!! "), " | ".join(prose(8, seed).split()), "be " * 12, prose(8, seed).replace(" ", "*** "))[seed % 4]


def labelled(n, first=0):
    rows = []
    for i in range(first, first + n):
        lines = [prose(12, 31 * i + j).capitalize() + "." for j in range(6)]
        if i % 3 == 0:
            lines[1:5] = [bad_line(31 * i + j) for j in range(4)]
        rows.append((i, "\n".join(lines), int(i % 3 != 0)))
    return rows


def test_quality_of_held_out_documents(spark, make_docs, odd_rows):
    train = spark.createDataFrame(labelled(150), "id long, text string, label int")
    noise = spark.createDataFrame([(None, "x", 1), (7, None, 0), (8, "", 0), (9, "fine", None), (10, "fine", 5)], "id long, text string, label int")
    field = linecrf.fit(train.unionByName(noise))
    held = labelled(90, 10_000)
    scores = {r["doc_id"]: r["score"] for r in linecrf.score(make_docs([(i, t, "en", "a") for i, t, _ in held]), field).collect()}
    assert np.mean([(scores[i] >= 0.3) == bool(y) for i, _, y in held]) > 0.95
    odd = linecrf.score(make_docs(odd_rows), field).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    assert next(r["score"] for r in odd if r["doc_id"] == 2) == 0.0


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(0)
    emission, transition = rng.normal(size=(9, 2)), rng.normal(size=(2, 2))
    doc = np.array([0, 0, 0, 0, 1, 3, 3, 3, 4])
    gamma, pairs, log_z = linecrf.marginals(emission, doc, transition)
    want, both, total = np.zeros((9, 2)), np.zeros((2, 2)), 0.0
    for d in np.unique(doc):
        at = np.flatnonzero(doc == d)
        paths = [np.array(list(np.binary_repr(k, len(at))), int) for k in range(1 << len(at))]
        weight = np.array([np.exp(emission[at, p].sum() + transition[p[:-1], p[1:]].sum()) for p in paths])
        total += np.log(weight.sum())
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            want[at, p] += w
            np.add.at(both, (p[:-1], p[1:]), w)
    assert np.allclose(gamma, want) and np.allclose(pairs, both) and log_z == pytest.approx(total)


def trained(texts, labels):
    lines = linecrf.Lines(texts)
    return linecrf.train(lines.features, lines.doc, lines.length, np.array(labels))


def test_a_long_text_in_blocks_scores_as_it_does_whole():
    field = trained([t.encode() for _, t, _ in labelled(40)], [y for *_, y in labelled(40)])
    text = ("\n".join(t for _, t, _ in labelled(70, 500)) + "\n\n" + "w" * 3000 + "\nlast").encode()
    want = field.raw(linecrf.Lines([text]), 1)[0]
    for size in (40, 700, 5000, 1 << 20):
        assert field.raw_long(text, size, 16) == pytest.approx(want, rel=1e-9)
        packed, lengths = linecrf.described(text, size)
        assert (np.unpackbits(packed, axis=1, count=linecrf.WIDTH) == linecrf.Lines([text]).features).all()
        assert (lengths == linecrf.Lines([text]).length).all()
    assert field.score([text, b"one"], 100).tolist() == pytest.approx(field.score([text, b"one"]).tolist())
    assert np.isnan(field.raw_long(b"\n \n", 1))


@pytest.mark.parametrize("n", [1, 2, 7, 16, 33, 500])
def test_long_marginals_equal_the_recursion(n):
    rng = np.random.default_rng(n)
    emission, transition = rng.normal(size=(n, 2)) * 3, rng.normal(size=(2, 2))
    want = linecrf.marginals(emission, np.zeros(n, np.int64), transition)[0]
    assert np.allclose(linecrf.long_marginals(emission, transition, 16), want, atol=1e-12)


def test_word_codes_do_not_depend_on_the_run(monkeypatch):
    text = (prose(50, 1) + " " + "x" * 200 + " " + prose(50, 1) + " " + "x" * 200).encode()
    buffer = np.frombuffer(text, np.uint8)
    blank = buffer == 32
    begin = np.flatnonzero(~blank & np.concatenate([[True], blank[:-1]]))
    end = np.flatnonzero(~blank & np.concatenate([blank[1:], [True]])) + 1
    whole = linecrf._word_codes(buffer, begin, end)
    assert len(set(whole.tolist())) == len(set(text.split()))
    monkeypatch.setattr(linecrf, "_RUN", 32)
    assert (linecrf._word_codes(buffer, begin, end) == whole).all()


def test_twenty_megabytes_of_short_lines_are_scored_in_bounded_memory():
    """In a process of its own, whose peak is read at the end."""
    code = (
        "import resource, numpy as np; from docketry.llm import linecrf as c;"
        "f = c.LineField(np.zeros((3 * c.WIDTH + 3, 2)), np.zeros((2, 2)), 1.0, 0.0, 0.0);"
        "t = b'a b\\n' * 2_500_000 + b'cd ef\\n' * 1_700_000;"
        "print(f.score([t])[0], resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)"
    )
    ran = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=300, cwd=os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    score, peak = ran.stdout.split()
    assert float(score) == pytest.approx(0.5) and int(peak) < 1000, ran.stderr


def test_the_sample_has_whole_documents(spark):
    rows = [(i, t, y) for i, t, y in labelled(30)] * 3 + [(1000, "\n".join(["good words here"] * 5000), 1)]
    table = spark.createDataFrame(rows, "id long, text string, label int").repartition(4)
    field = linecrf.fit(table, most_lines=1000)
    assert np.array_equal(field.weights, linecrf.fit(table.dropDuplicates().where("id < 1000"), most_lines=1000).weights)


@pytest.mark.parametrize("scale", ["0.01"])
def test_registered_models_on_held_out_documents(spark, scale):
    from docketry.llm import queries

    sf_dir = f"/root/testdata/sf{scale}"
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    scored = queries.op7_quality(spark, sf_dir).join(labels, "doc_id").where("held_out").collect()
    assert len(scored) > 50 and np.mean([r["predicted"] == r["quality"] for r in scored]) >= 0.97
    spoken = queries.op8_language(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert len(spoken) > 200 and np.mean([r["lang_pred"] == r["lang"] for r in spoken]) >= 0.98


def test_lines_do_not_depend_on_the_batch():
    texts = [t.encode() for _, t, _ in labelled(12)] + [b"", b"\n\n", b"one"]
    field = trained(texts, [y for *_, y in labelled(12)] + [0, 0, 1])
    alone = np.concatenate([field.score([t]) for t in texts])
    assert np.allclose(alone, field.score(texts))


def test_one_label_teaches_nothing():
    field = trained([b"a b", b"c d"], [1, 1])
    assert field.score([b"x y"]).tolist() == [0.5]


# --- language ----------------------------------------------------------------------------------

TONGUES = {"en": "the of and to in that with this from have", "de": "der und die nicht mit eine für auch sich über", "fr": "les des une dans avec être était déjà pour où"}


def speech(lang, seed, n=25):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice(TONGUES[lang].split(), n))


def test_language_of_held_out_documents(make_docs, odd_rows):
    rows = [(i, speech(lang, 7 * i + k), lang, "a") for i in range(60) for k, lang in enumerate(TONGUES)]
    model = langid.fit(make_docs(rows + odd_rows[:1] + [(5, None, "en", "a"), (6, "x", None, "a")]).select("text", "lang"))
    assert model.languages == sorted(TONGUES)
    held = [(i, speech(lang, 90_000 + 7 * i + k, 8), lang, "a") for i in range(30) for k, lang in enumerate(TONGUES)]
    got = langid.identify(make_docs(held), model).collect()
    assert np.mean([r["lang_pred"] == r["lang"] for r in got]) > 0.97
    odd = langid.identify(make_docs(odd_rows), model).collect()
    assert len(odd) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in odd)
    by = {r["doc_id"]: r for r in odd}
    assert all((by[i]["lang_pred"], by[i]["score"]) == ("und", 0.0) for i in (1, 2, 3, 10))
    assert by[9]["lang_pred"] == "de"


def test_counting_is_the_same_however_it_is_split(make_docs, monkeypatch):
    rows = [(i, speech("en", i, 200), "en", "a") for i in range(10)]
    one = langid.fit(make_docs(rows, 1).select("text", "lang"))
    many = langid.fit(make_docs(rows, 6).select("text", "lang"))
    assert np.allclose(one.table, many.table)


def test_scores_equal_a_sum_by_dictionary(make_docs, odd_rows):
    rows = [(i, speech(lang, 7 * i + k), lang, "a") for i in range(10) for k, lang in enumerate(TONGUES)]
    model = langid.fit(make_docs(rows).select("text", "lang"), columns=1 << 12)
    texts = [t for _, t, *_ in odd_rows + rows] + ["a\0b", "\0", "x" * 5, "  1a 2  b"]

    def brute(text):
        spaced = "".join(c if c.isalpha() else " " for c in f" {text or ''} ".lower())
        spaced = re.sub(" +", " ", spaced)
        total = model.prior.copy()
        for n in langid.ORDERS:
            for i in range(len(spaced) - n + 1):
                total += model.table[langid.ngram_columns(np.array([ord(c) for c in spaced[i : i + n]], np.uint32), 1 << 12)[0][-1]]
        if not spaced.strip():
            return langid.UNKNOWN, 0.0
        return model.languages[int(total.argmax())], 1.0 / np.exp(total - total.max()).sum()

    short = [t for t in texts if t is None or len(t) < 3000]
    want = [brute(t) for t in short]
    names, shares = model.score(short)
    assert names == [w[0] for w in want] and shares == pytest.approx([w[1] for w in want], abs=1e-6)
    assert model.score(texts)[0][: len(texts)] == [model.score([t])[0][0] for t in texts]


def test_pieces_of_a_batch_change_nothing(make_docs, odd_rows, monkeypatch):
    rows = [(i, speech(lang, 7 * i + k), lang, "a") for i in range(10) for k, lang in enumerate(TONGUES)]
    model = langid.fit(make_docs(rows).select("text", "lang"))
    texts = [t for _, t, *_ in odd_rows + rows]
    names, shares = model.score(texts)
    monkeypatch.setattr(langid, "_PIECE", 100)
    again, other = model.score(texts)
    assert again == names and other == pytest.approx(shares, abs=1e-9)


def test_languages_beyond_what_a_task_holds(make_docs):
    rows = [(i, f"{prose(6, i % 40)} x", f"l{i % 40}", "a") for i in range(120)]
    model = langid.fit(make_docs(rows).select("text", "lang"))
    assert len(model.languages) == 40 and np.allclose(np.exp(model.table.astype(float)).sum(axis=0), 1.0, atol=1e-3)
    with pytest.raises(Exception, match="languages"):
        langid.fit(make_docs(rows).select("text", "lang"), most_languages=39)


def test_letters_beyond_the_basic_plane():
    assert (langid.code_points("𐌰 1") != 32).any()
    assert not (langid.code_points("😀 ! 5") != 32).any()


def test_quality_fit_leaves_texts_where_they_are(spark, monkeypatch):
    rows = [(i % 90, "good words here\n" * (i % 7 + 1) if i % 2 else "x | y\n$$$ %\n" * (i % 5), i % 2) for i in range(120)] + [(91, None, 1), (None, "lost", 0)]
    texts = spark.createDataFrame([(i, t) for i, t, _ in rows], "id long, text string")
    labels = spark.createDataFrame(sorted({(i, y) for i, _, y in rows if i is not None}), "id long, label int")
    seen = []
    plain = linecrf._line_table
    monkeypatch.setattr(linecrf, "_line_table", lambda rows: seen.append(rows._jdf.queryExecution().executedPlan().toString()) or plain(rows))
    with_join = linecrf.fit(labels.join(texts, "id"), most_docs=40)
    apart = linecrf.fit(labels, most_docs=40, texts=texts)
    assert np.array_equal(with_join.weights, apart.weights) and with_join.offset == apart.offset
    assert "BroadcastHashJoin" in seen[1] and "Exchange hashpartitioning" not in seen[1]
