"""The registered queries: their columns, types and digests by definition, on odd rows and on empty tables."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from tokenizers import Tokenizer

from tickframe.llm import catalog
from tickframe.llm._tokens import default_tokenizer

COLUMNS = {
    "op1_simhash_pivots": "doc_id bigint, fingerprint string, component_id bigint",
    "op2_token_files": "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint",
    "op3_compression_bands": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
                             "base_failed boolean, kept boolean",
    "op4_warc_revisit": "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint",
    "op5_toxicity_cnn": "doc_id bigint, held_out boolean, score double, predicted int",
    "op6_unigram_pieces": "doc_id bigint, n_pieces bigint, ids_crc32 bigint, round_trip boolean",
    "op7_cover_dedup": "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string",
    "op8_cutting_stock": "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint",
    "op9_kmeans_tree": "query_id bigint, rank int, vec_id bigint, score double",
    "op10_cross_parsing": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op11_bloom_variants": "word string, form string, root string, n bigint, n_near bigint, form_n bigint",
    "op12_maxscore": "query_id bigint, rank int, vec_id bigint, score bigint",
    "op13_periodic_runs": "doc_id bigint, n_runs bigint, start bigint, length bigint, period bigint, exponent_milli bigint, "
                          "runs_sha256 string, collapsed_sha256 string",
}
VECTOR = "vec_id bigint, embedding array<float>, label int"


def texts():
    rng = random.Random(8)
    words = {"en": "the of and in that water stone river bread light".split(), "de": "der die und das wasser stein fluss brot licht ist".split()}
    rows = []
    for i in range(90):
        lang = rng.choice(["en", "de"])
        own = [rng.choice(words[lang]) + (str(rng.randrange(60)) if rng.random() < 0.5 else "") for _ in range(rng.randrange(12, 90))]
        if i % 3 == 0:
            own.insert(5, "scum" if lang == "en" else "lump")
        rows.append((i, " ".join(own), lang))
    passage = " ".join(f"shared{i}" for i in range(30))
    rows += [(100, rows[3][1], rows[3][2]), (101, passage + " one", "en"), (102, "two # " + passage, "en"), (103, None, "en"), (104, "", None),
             (105, " \t\n", "de"), (106, "line\nline\n\nline end <|endoftext|>", "en"), (107, "aa " * 40, None), (108, "É b É b", "de")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


@pytest.fixture(scope="module")
def folder(workers, make_docs, rows, tmp_path_factory):
    path, rng = str(tmp_path_factory.mktemp("queries")), np.random.default_rng(3)
    make_docs(rows).repartition(3).write.parquet(f"{path}/documents.parquet")
    workers.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id bigint, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    pages = [(i, f"http://h/{i}", f"<p>page {i % 12}</p>") for i in range(40)] + [(50, None, None), (51, "http://h/é x", ""), (52, "http://h", "ü" * 500)]
    workers.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{path}/pages.parquet")
    vectors = [(i, rng.normal(size=8).tolist(), 0) for i in range(120)] + [(150, None, 0), (200, [0.0] * 8, 1)]
    workers.createDataFrame(vectors, VECTOR).write.parquet(f"{path}/embeddings.parquet")
    return path


@pytest.fixture(scope="module")
def results(workers, folder):
    return {name: (lambda f: (f.dtypes, [r.asDict() for r in f.collect()]))(query(workers, folder)) for name, query in catalog.llm_queries().items()}


def by_id(results, name):
    return {r["doc_id"]: r for r in results[name][1]}


def test_columns_and_types(results):
    assert set(results) == set(COLUMNS)
    for name, (dtypes, _) in results.items():
        want = [tuple(c.split()) for c in COLUMNS[name].split(", ")]
        assert set(want) <= set(dtypes), name


def test_a_row_for_each_document(results, rows):
    for name in ("op1_simhash_pivots", "op2_token_files", "op3_compression_bands", "op5_toxicity_cnn", "op6_unigram_pieces", "op7_cover_dedup",
                 "op10_cross_parsing", "op13_periodic_runs"):
        assert sorted(r["doc_id"] for r in results[name][1]) == sorted(r[0] for r in rows), name


def test_fingerprints(results, rows):
    prints = {}
    for d, text, _ in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
        hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 4]), 42) for i in range(max(1, len(words) - 3))] if words else []
        prints[d] = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    found = by_id(results, "op1_simhash_pivots")
    assert {d: r["fingerprint"] for d, r in found.items()} == {d: f"{p:016x}" for d, p in prints.items()}
    assert found[100]["component_id"] == 3 and found[105]["component_id"] == 103 == found[104]["component_id"]


def test_tokens_and_packing(results, rows):
    tokenizer, at = Tokenizer.from_file(default_tokenizer()), 0
    tokens, packed = by_id(results, "op2_token_files"), {}
    for r in results["op8_cutting_stock"][1]:
        packed.setdefault(r["doc_id"], []).append(r)
    for d, text, _ in sorted(rows, key=lambda r: r[0]):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        raw = np.array([*ids, 2], dtype="<u4")
        assert tokens[d] == {"doc_id": d, "start": at, "n_tokens": len(raw), "ids_crc32": zlib.crc32(raw.tobytes())}
        at += len(raw)
        raw = np.array([*ids, 1], dtype="<u4")
        assert sum(r["length"] for r in packed[d]) == len(raw) == packed[d][0]["doc_tokens"]
        for r in packed[d]:
            assert r["ids_crc32"] == zlib.crc32(raw[r["start"]:r["start"] + r["length"]].tobytes())


def test_quality_counts(results, rows):
    found = by_id(results, "op3_compression_bands")
    for d, text, _ in rows:
        words = [w.decode() for w in (text or "").encode().split()]
        lines = [line for line in (text or "").split("\n") if line.encode().split()]
        windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
        covered = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
        r = found[d]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (
            len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered))
        assert r["base_failed"] == (len(words) < 10 or 100 * len(covered) > 20 * len(words)) and not (r["base_failed"] and r["kept"])


def test_archive_records(results, workers, folder):
    pages = {r["page_id"]: (r["html"] or "").encode() for r in workers.read.parquet(f"{folder}/pages.parquet").collect()}
    first = {}
    for i in sorted(pages):
        first.setdefault(pages[i], i)
    want = {i: (len(p), base64.b32encode(hashlib.sha1(p).digest()).decode(), "response" if first[p] == i else "revisit", None if first[p] == i else first[p])
            for i, p in pages.items()}
    assert {r["page_id"]: tuple(r.values())[1:] for r in results["op4_warc_revisit"][1]} == want


def test_held_out_documents_and_verdicts(results, rows):
    toxic, language = by_id(results, "op5_toxicity_cnn"), by_id(results, "op10_cross_parsing")
    for d, text, lang in rows:
        h = zlib.crc32(str(d).encode())
        assert toxic[d]["held_out"] == (h % 5 == 0) and language[d]["held_out"] == (h % 3 == 1)
        assert 0 <= toxic[d]["score"] <= 1 and toxic[d]["predicted"] == int(toxic[d]["score"] >= 0.5) and 0 <= language[d]["score"] <= 1
        has_letter = any(c.isalpha() for c in text or "")
        assert (language[d]["lang_pred"] == "und") == (not has_letter) and language[d]["lang_pred"] in ("en", "de", "und")
        if d < 90:
            assert language[d]["lang_pred"] == lang


def test_passages(results, rows):
    seen, found = set(), by_id(results, "op7_cover_dedup")
    for d, text, _ in sorted(rows, key=lambda r: r[0]):
        words, gone = (text or "").encode().split(), set()
        for i in range(len(words) - 19):
            window = tuple(words[i:i + 20])
            if window in seen:
                gone.update(range(i, i + 20))
            seen.add(window)
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        assert tuple(found[d].values()) == (d, len(words), len(gone), hashlib.sha256(left).hexdigest())


def test_neighbours(results, workers, folder):
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=float) for r in workers.read.parquet(f"{folder}/embeddings.parquet").collect()
               if r["embedding"] and any(r["embedding"])}
    unit = {i: v / np.sqrt(v @ v) for i, v in vectors.items()}
    hits, total = 0, 0
    for q in (0, 50, 100):
        want = sorted((i for i in vectors if i != q), key=lambda i: (-float(unit[q] @ unit[i]), i))[:5]
        got = [r["vec_id"] for r in sorted(results["op9_kmeans_tree"][1], key=lambda r: r["rank"]) if r["query_id"] == q]
        hits, total = hits + len({*want} & {*got}), total + 5
        assert len(got) == 5
    assert hits >= 0.9 * total and {r["query_id"] for r in results["op9_kmeans_tree"][1]} == {0, 50, 100}


def test_empty_tables(workers, make_docs, tmp_path):
    make_docs([]).write.parquet(f"{tmp_path}/documents.parquet")
    for name, schema in (("labels", "doc_id bigint, quality int, toxic int"), ("pages", "page_id bigint, url string, html string"), ("embeddings", VECTOR)):
        workers.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for name, query in catalog.llm_queries().items():
        found = query(workers, str(tmp_path))
        want = [tuple(c.split()) for c in COLUMNS[name].split(", ")]
        assert set(want) <= set(found.dtypes) and found.collect() == [], name
