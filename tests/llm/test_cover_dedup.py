import random

import pytest

from tickframe.llm import cover_dedup as D


def plain(rows, window):
    """Kept words by definition, in the order of (doc_id, text hash is not needed: ids differ)."""
    seen, out = set(), {}
    for d, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        words = (text or "").encode().split()
        gone = set()
        for i in range(len(words) - window + 1):
            run = tuple(words[i:i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        out[d] = (len(words), len(gone), b" ".join(w for i, w in enumerate(words) if i not in gone).decode())
    return out


def shared_passages(seed, n, words):
    rng = random.Random(seed)
    passages = [[rng.choice(words) for _ in range(rng.randrange(15, 60))] for _ in range(6)]
    rows = []
    for d in range(n):
        text = []
        for _ in range(rng.randrange(1, 6)):
            text += rng.choice(passages) if rng.random() < 0.5 else [rng.choice(words) for _ in range(rng.randrange(40))]
        rows.append((d * 13 % 1009, rng.choice([" ", "\n", " \t"]).join(text)))
    return rows


@pytest.mark.parametrize("window", [20, 5, 1])
def test_equals_the_definition(make_docs, window):
    rows = shared_passages(window, 120, [f"w{i}" for i in range(200)])
    rows += [(2000, None), (2001, ""), (2002, "same " * 400), (2003, rows[3][1]), (2004, "é　b " * 30), (None, rows[5][1]),
             (2005, " ".join(f"u{i}" for i in range(60_000)))]
    found = D.remove_repetitions(make_docs(rows, "'x' AS Kept_Text"), window).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_text"]) for r in found} == plain(rows, window)
    assert len(found) == len(rows)


def test_repeated_rows_are_one_document(make_docs):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage), (1, passage), (2, passage + " more"), (3, "short"), (3, "other text")]
    found = sorted(tuple(r) for r in D.remove_repetitions(make_docs(rows, "7 AS row")).select("doc_id", "n_removed", "kept_text").collect())
    assert found == [(1, 0, passage), (1, 0, passage), (2, 30, "more"), (3, 0, "other text"), (3, 0, "short")]


@pytest.mark.parametrize("repeated", [False, True])
def test_columns_of_any_name_stay(make_docs, repeated):
    passage = " ".join(f"p{i}" for i in range(30))
    rows = [(1, passage), (2, passage + " more")] + [(2, passage + " more")] * repeated
    names = "row repeats places d t text_hash key more place n".split()
    docs = make_docs(rows).selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names))
    found = D.remove_repetitions(docs)
    assert found.columns == [*docs.columns, "n_words", "n_removed", "kept_text"]
    for r in found.collect():
        assert all(r[n] == f"{n}{r['doc_id']}" for n in names) and r["kept_text"] == (passage if r["doc_id"] == 1 else "more")


def test_empty_table(make_docs):
    assert D.remove_repetitions(make_docs([])).count() == 0


def test_covers_meet_every_shift():
    for window in (1, 2, 5, 10, 20, 50):
        period = D.period_for(window)
        cover = set(D.difference_cover(period))
        for i in range(period):
            for j in range(period):
                assert any((i + s) % period in cover and (j + s) % period in cover for s in range(period))
        assert period - 1 + (window - period + 1) <= window
    assert len(D.difference_cover(13)) == 4


def test_windows_leave_in_the_order_of_texts_and_repeats_of_a_batch_share_a_key(spark):
    passage = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i, f"a{i} {passage} z{i}") for i in range(6)], "row bigint, text string").coalesce(1)
    anchors = D._repeated_anchors(D._anchors(docs, 20))
    joined = docs.join(anchors, "row").select("row", "text", "places").coalesce(1).sortWithinPartitions("row")
    rows = [(r["row"], r["more"] & 0x7FFFFFFF, r["more"] >> 31 & 1, r["key"]) for r in D._windows(joined, 20).collect()]
    assert [r[:2] for r in rows] == sorted(r[:2] for r in rows)
    assert all(later == (row > 0) for row, place, later, _ in rows if 1 <= place <= 11)
    assert all(len({key for row, _, later, key in rows if row == n and later}) == 1 for n in range(1, 6))
    assert all(0 <= r["key"] < 1 << 48 for r in D._anchors(docs, 20).collect())
