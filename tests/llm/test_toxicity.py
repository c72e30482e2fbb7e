import random

import numpy as np

from tickframe.llm import toxicity_cnn as X


def corpus(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        lang = rng.choice(["en", "de"])
        words = [rng.choice("the of and to in by".split() if lang == "en" else "der die und das ist ein".split()) for _ in range(40)]
        bad = rng.random() < 0.4
        if bad:
            for _ in range(2):
                words.insert(rng.randrange(40), rng.choice(["scum", "idiot"]) if lang == "en" else "lowei" + rng.choice("abcdefgh"))
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(bad)))
    return rows, labels


def test_held_out_accuracy_and_odd_rows(make_docs, workers):
    rows, labels = corpus(900, 1)
    learn = workers.createDataFrame([r for r in labels if r[0] < 600] + [(None, 1), (5000, 1), (3, None)], "doc_id bigint, toxic int")
    model = X.fit(make_docs(rows), learn)
    odd = [(2000, None), (2001, ""), (2001, ""), (2002, " ".join(["the of"] * 40_000) + " scum idiot"), (None, "the scum idiot of")]
    found = X.score(make_docs(rows[600:] + odd, "'x' AS Score"), model).collect()
    assert len(found) == 300 + len(odd)
    truth = dict(labels)
    right = [r["predicted"] == truth[r["doc_id"]] for r in found if r["doc_id"] is not None and r["doc_id"] < 1000]
    assert np.mean(right) > 0.95
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in found)
    by = {r["doc_id"]: r for r in found}
    assert by[2000]["predicted"] == by[2001]["predicted"] == 0 and by[2000]["score"] == by[2001]["score"]
    assert by[2002]["predicted"] == by[None]["predicted"] == 1
    assert set(model.calibration) == {"de", "en"}


def test_score_does_not_depend_on_neighbours(make_docs, workers):
    rows, labels = corpus(300, 2)
    model = X.fit(make_docs(rows), workers.createDataFrame(labels, "doc_id bigint, toxic int"))
    texts = [t for _, t, _ in rows]
    whole = X.predict(model, texts)
    assert np.allclose([X.predict(model, [t])[0] for t in texts[:40]], whole[:40], atol=1e-5)


def test_without_labels_of_both_classes_nothing_is_toxic(make_docs, workers):
    model = X.fit(make_docs([(1, "scum")]), workers.createDataFrame([(1, 1)], "doc_id bigint, toxic int"))
    assert [r["predicted"] for r in X.score(make_docs([(1, "scum"), (2, None)]), model).collect()] == [0, 0]
    assert X.score(make_docs([]), model).count() == 0


def test_thresholds_maximise_f1():
    logit, label = np.array([3.0, 2.0, 1.0, 0.0, -1.0]), np.array([1, 1, 0, 1, 0])
    assert X._threshold(logit, label, np.ones(5)) == -0.5
    assert X._threshold(logit, label, np.where(label == 1, 1.0, 9.0)) == 1.5


def test_the_sample_is_bounded_before_the_driver(make_docs, workers, collected, monkeypatch):
    rows, labels = corpus(300, 6)
    rows += [(1000 + i, rows[i][1] + " the of" * 30_000, rows[i][2]) for i in range(40)]
    labels += [(1000 + i, y) for i, y in labels[:40]]
    monkeypatch.setattr(X, "MAX_CHARS_A_TEXT", 3000)
    monkeypatch.setattr(X, "MAX_WORDS_FITTED", 12_000)
    model = X.fit(make_docs(rows + rows[:20]), workers.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert 0 < sum(collected) <= 6 * 12_000 + 6 * len(rows) and max(collected) == 3000
    assert X.predict(model, ["the of scum idiot to and"])[0] > 0.5 > X.predict(model, ["the of to and in by"])[0]


def plain_score(model, text):
    """One text by a loop over words, filters and offsets, each contribution read from the table."""
    words = [X._features(w) for w in (text or "").split()]
    rows = [sum(model.table[b].astype(float) for b in buckets) for buckets in words]
    zero = np.zeros(model.table.shape[1])
    place = lambda i: rows[i] if i < len(rows) else zero
    hidden, column = [], 0
    for k, width in enumerate(X.WIDTHS):
        for f in range(X.FILTERS):
            sums = [sum(place(i + o)[column + o * X.FILTERS + f] for o in range(width)) for i in range(max(1, len(rows)))]
            hidden.append(max(0.0, max(sums) + model.bias[k * X.FILTERS + f]))
        column += width * X.FILTERS
    logit = float(np.dot(hidden, model.out)) + model.intercept
    shares = [sum(r[column + n] for r in rows) for n in range(len(model.languages))]
    threshold = model.thresholds[int(np.argmax(shares)) if shares else 0]
    return 1 / (1 + np.exp(-min(40.0, max(-40.0, logit - threshold))))


def test_scores_equal_a_plain_loop(make_docs, workers):
    rows, labels = corpus(300, 3)
    model = X.fit(make_docs(rows), workers.createDataFrame(labels, "doc_id bigint, toxic int"))
    texts = [None, "", "scum", "the of scum idiot", "... !!", "der loweia und", "unseen wörter 12"] + [t for _, t, _ in rows[:25]]
    found = X.predict(model, texts)
    assert np.allclose(found, [plain_score(model, t) for t in texts], atol=2e-4)
    assert len({round(x, 3) for x in found}) > 5


def test_all_labelled_documents_are_learned_from(make_docs, workers, monkeypatch):
    rng = random.Random(8)
    bad = ["".join(rng.choice("bcdfgklmnprstvwz") + rng.choice("aeiou") for _ in range(4)) for _ in range(40)]
    rows, labels = [], []
    for i in range(1000):
        words = [rng.choice("the of and to in by".split()) for _ in range(30)]
        if i % 3 == 0:
            words[rng.randrange(30)] = bad[i // 3 % 40]
        rows.append((i, " ".join(words), "it" if i % 50 == 49 else "en"))
        labels.append((i, int(i % 3 == 0)))
    monkeypatch.setattr(X, "DOCS_PER_SHARD", 150)
    model = X.fit(make_docs(rows), workers.createDataFrame(labels[:800], "doc_id bigint, toxic int"), docs_per_class=6)
    assert model.languages == ["en", "it"]
    found = X.predict(model, [t for _, t, _ in rows[800:]]) >= 0.5  # a sample of 12 documents holds 6 of the 40 words at most
    assert np.mean(found == [y for _, y in labels[800:]]) > 0.95


def test_many_languages_are_counted_together(make_docs, workers, monkeypatch):
    rows, labels = corpus(300, 9)
    rows = [(i, t, f"{i % 7}" if i % 5 == 0 else lang) for i, t, lang in rows]
    monkeypatch.setattr(X, "MAX_LANGUAGES", 2)
    model = X.fit(make_docs(rows), workers.createDataFrame(labels, "doc_id bigint, toxic int"))
    assert model.languages == ["de", "en", X.OTHER_LANGUAGES] and model.table.shape[1] == X._COLUMNS + 3


def test_long_texts_come_in_pieces(make_docs, workers, monkeypatch):
    rows, labels = corpus(300, 10)
    model = X.fit(make_docs(rows), workers.createDataFrame(labels, "doc_id bigint, toxic int"))
    words = X._rows_of_table(model.table)
    ids, rows_of = words.numbers([t for _, t, _ in rows[:20]] + ["", "scum"])
    rows_of[words.count] = 0
    want = X._raw_scores(model, ids, rows_of, words.count)
    flat, bounds = X._spread(ids, words.count)
    tops = X._tops(rows_of[:words.count + 1, :X._COLUMNS], flat, bounds)
    monkeypatch.setattr(X, "PLACES_AT_ONCE", 7)
    for a, b in zip(X._raw_scores(model, ids, rows_of, words.count), want, strict=True):
        assert np.allclose(a, b, atol=1e-5)
    for a, b in zip(X._tops(rows_of[:words.count + 1, :X._COLUMNS], flat, bounds), tops, strict=True):
        assert np.array_equal(a, b)


def test_a_step_follows_the_gradient():
    rng = np.random.default_rng(4)
    params = [p.astype(np.float64) for p in X._started(rng.normal(size=X.BUCKETS), 1)]
    params[-3] += rng.normal(0, 0.1, X._OUTPUTS)  # no text's maximum lies where the filters' output bends
    buckets = rng.integers(1, 30, (12, X._FEATURES))
    ids, label, weight = [rng.integers(0, 12, n).astype(np.int32) for n in (9, 1, 0, 5)], np.array([1, 0, 1, 0]), np.array([0.6, 1.7])

    def loss(at):
        table, *filters, bias, out, intercept = at
        total = 0.0
        for words, y in zip(ids, label, strict=True):
            vectors = np.vstack([table[buckets[words]].sum(axis=1), np.zeros((3, X.DIMENSIONS))])
            tops = [max(sum(vectors[i + o] @ f[o] for o in range(len(f)))[k] for i in range(max(1, len(words))))
                    for f in filters for k in range(X.FILTERS)]
            p = 1 / (1 + np.exp(-(np.maximum(np.array(tops) + bias, 0) @ out + intercept[0])))
            wanted = y * (1 - X.SMOOTHING) + X.SMOOTHING / 2
            total -= weight[y] * (wanted * np.log(p) + (1 - wanted) * np.log(1 - p)) / len(label)
        return total

    training = X._Training([p.copy() for p in params], weight)
    training.step(buckets, ids, label)
    for n, p in enumerate(params):
        for at in rng.permutation(np.flatnonzero(training.first[n]))[:6]:
            ends = []
            for change in (1e-6, -1e-6):
                moved = [q.copy() for q in params]
                moved[n].ravel()[at] += change
                ends.append(loss(moved))
            assert np.isclose((ends[0] - ends[1]) / 2e-6, training.first[n].ravel()[at] / 0.1, rtol=1e-4, atol=1e-8), (n, at)
