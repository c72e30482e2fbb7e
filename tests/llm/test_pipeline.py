import random

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as P
from tickframe.llm import catalog
from tickframe.llm._tokens import default_tokenizer

WORDS = {"en": "the of and in that water stone river bread light".split(), "de": "der die und das wasser stein fluss brot licht ist".split()}


def plain_cut(texts, window):
    """Texts without windows that started earlier, by definition; those that lose all words are gone."""
    seen, out = set(), {}
    for d, text in sorted(texts.items()):
        words, gone = text.encode().split(), set()
        for i in range(len(words) - window + 1):
            run = tuple(words[i:i + window])
            if run in seen:
                gone.update(range(i, i + window))
            seen.add(run)
        if len(gone) < len(words):
            out[d] = b" ".join(w for i, w in enumerate(words) if i not in gone).decode() if gone else text
    return out


def corpus():
    rng = random.Random(11)
    shared = " ".join(f"passage{i}" for i in range(70))
    rows, labels, notes = [], [], {}
    for i in range(260):
        lang = rng.choice(["en", "de"])
        words = [rng.choice(WORDS[lang]) + (str(rng.randrange(40)) if rng.random() < 0.7 else "") for _ in range(60)]
        toxic = rng.random() < 0.4
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(60), rng.choice(["scum", "idiot"]) if lang == "en" else "lowei" + rng.choice("abcd"))
        rows.append((i, " ".join(words), lang))
        labels.append((i, int(toxic)))
    clean = [i for i, y in labels if not y]
    for n, i in enumerate(clean[:6]):  # copies, and copies of a passage inside other documents
        rows.append((1000 + n, rows[i][1], rows[i][2]))
        rows.append((1100 + n, rows[clean[20 + n]][1] + " " + shared + f" end{n}", rows[clean[20 + n]][2]))
    rows += [(1200, None, "en"), (1201, "", "en"), (1202, "12 34 !", "en"), (1203, "i", "en")]  # one letter: both languages have it
    notes["toxic"] = {i for i, y in labels if y}
    notes["copies"] = {1000 + n for n in range(6)}
    return rows, labels, notes


@pytest.fixture(scope="module")
def folder(workers, make_docs, tmp_path_factory):
    rows, labels, notes = corpus()
    path = str(tmp_path_factory.mktemp("sf"))
    make_docs(rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    workers.createDataFrame([(i, 1, y) for i, y in labels], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path, rows, notes


def test_stages_take_effect(workers, folder):
    path, rows, notes = folder
    docs = workers.read.parquet(f"{path}/documents.parquet")
    columns, text = docs.columns, {r[0]: r[1] for r in rows}
    kept = {}
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(workers, docs, path), name)
        assert docs.columns == columns
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(text) - set(kept["language"]) == {1200, 1201, 1202, 1203}
    gone = set(kept["language"]) - set(kept["toxicity"])
    clean = set(kept["language"]) - notes["toxic"]
    assert len(gone & notes["toxic"]) > 0.9 * len(notes["toxic"]) and len(gone & clean) <= 0.03 * len(clean)
    assert not set(kept["near_duplicates"]) & {c for n, c in enumerate(sorted(notes["copies"]))
                                               if any(kept["toxicity"].get(i) == kept["toxicity"].get(c) for i in kept["toxicity"] if i < c)}
    assert kept["passages"] == plain_cut(kept["near_duplicates"], 20)
    pieces = P.STAGES[-1][1](workers, docs, path).collect()
    tokenizer = Tokenizer.from_file(default_tokenizer())
    want = {d: len(tokenizer.encode(t, add_special_tokens=False).ids) + 1 for d, t in kept["passages"].items()}
    got = {}
    for r in pieces:
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + r["length"]
    assert got == want


def test_language_stage_keeps_the_wanted_languages(workers, folder):
    path, rows, _ = folder
    kept = {r["doc_id"]: r["lang"] for r in P.language(workers, workers.read.parquet(f"{path}/documents.parquet"), path, ["de"]).collect()}
    german = {d for d, t, lang in rows if lang == "de" and t}
    assert set(kept.values()) == {"de"} and len(kept) >= 0.95 * len(german)


def test_run_gives_the_last_stage(workers, folder):
    found = P.run(workers, folder[0])
    assert found.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    ids = np.array([r["doc_id"] for r in found.collect()])
    assert len(ids) > 50 and not set(ids.tolist()) & {1200, 1201, 1202, 1203}


def test_empty_documents(workers, make_docs, folder):
    docs = make_docs([])
    for _, stage in P.STAGES:
        assert stage(workers, docs, folder[0]).count() == 0


def test_every_operator_has_one_query():
    numbers = sorted(int(name[2:].split("_")[0]) for name in catalog.llm_queries())
    assert numbers == list(range(1, 14))


def test_columns_of_any_name_pass_unchanged(workers, folder):
    path, rows, _ = folder
    names = """row repeats places node score lang_pred predicted n_words n_removed kept_text fp f class_id component d t
        text_hash __text_hash chosen_id chosen_hash key more place toxic hash rank a b k m""".split()
    docs = workers.read.parquet(f"{path}/documents.parquet").where("doc_id < 60 or doc_id >= 1000")
    docs = P.written(docs.selectExpr("*", *(f"concat('{n} ', doc_id) AS `{n}`" for n in names)), "clashing")
    columns = docs.columns
    for name, stage in P.STAGES[:-1]:
        docs = P.written(stage(workers, docs, path), name)
        assert docs.columns == columns
        found = docs.collect()
        assert found and all(r[n] == f"{n} {r['doc_id']}" for r in found for n in names), name
    assert P.STAGES[-1][1](workers, docs, path).count() > 0
