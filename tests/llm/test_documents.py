"""Operators over documents against plain versions, on the smallest tables and on awkward rows."""

import itertools
import string
import time

import duckdb
import numpy as np
import plain
import public_tokenizers
import pyarrow as pa
import pytest
from checker import compare

from pyspark.sql import functions as F
from slowtide.llm import binary, language, licenses, packing, quality, simhash, tokens, viterbi
from slowtide.llm.common import pick
from slowtide.session import materialize


def empty(spark):
    return spark.createDataFrame([], plain.SCHEMA)


def by_id(rows):
    return sorted(rows, key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, tuple(map(str, r))))


def pairs(docs):
    return [(r["doc_id"], r["text"]) for r in pick(docs, "doc_id", "text").collect()]


# quality rules


@pytest.mark.parametrize("which", ["edge", "table"])
def test_base_rules(spark, which):
    docs = plain.edge_docs(spark) if which == "edge" else plain.documents(spark)
    model = quality.Model(np.zeros(quality.BUCKETS, np.int64), 0.0)
    got = quality.judge(pick(docs, "doc_id", "text"), model).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert sorted((str(r["doc_id"]), *[r[n] for n in names], r["kept"]) for r in got) == sorted(
        (str(d), *(b := plain.base_rules(t)), not b[-1]) for d, t in pairs(docs)
    )


def test_likelihood_ratio(spark):
    docs, labels = plain.documents(spark), plain.documents(spark, "labels")
    model = quality.fit(docs, labels)
    good = {r["doc_id"] for r in labels.filter("quality = 1 and toxic = 0").collect()}
    raw, target = np.zeros(quality.BUCKETS), np.zeros(quality.BUCKETS)

    def buckets(text):
        b = (text or "").encode()
        return [(int.from_bytes(b[i : i + 4], "little") * 2654435761 & 0xFFFFFFFF) >> 16 for i in range(len(b) - 3)]

    for d, t in pairs(docs):
        for x in buckets(t):
            raw[x] += 1
            target[x] += d in good
    ratio = np.log((target + 1) / (target.sum() + len(raw))) - np.log((raw + 1) / (raw.sum() + len(raw)))
    want = {d: np.mean(ratio[buckets(t)]) if len(buckets(t)) else 0 for d, t in pairs(docs)}
    got = {r["doc_id"]: r for r in quality.judge(pick(docs, "doc_id", "text"), model).collect()}
    assert all(abs(got[d]["score"] - s) < 1e-5 for d, s in want.items())
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= model.threshold) for r in got.values())
    # clean documents stay, junk that the base rules let through goes
    told = {r["doc_id"]: r["quality"] for r in labels.collect()}
    clean = [r["kept"] for d, r in got.items() if d in good and not r["base_failed"]]
    junk = [r["kept"] for d, r in got.items() if told.get(d) == 0 and not r["base_failed"]]
    assert np.mean(clean) > 0.98 and (not junk or np.mean(junk) < 0.5)


def test_quality_without_documents_or_labels(spark):
    labels = spark.createDataFrame([(1, None, None), (None, 1, 0), (2, 1, 0), (2, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(plain.edge_docs(spark), labels)
    assert model.threshold == 0 and not model.ratios.any()
    assert quality.judge(pick(empty(spark), "doc_id", "text"), quality.fit(empty(spark), labels)).collect() == []


# language


def test_language_held_out(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    net = language.fit(docs)
    got = language.identify(pick(docs, "doc_id", "text", "lang"), net, keep=("doc_id", "lang", "text")).collect()
    out = [r for r in got if __import__("zlib").crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert len(got) == docs.count() and 100 < len(out) < 300
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) > 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


def test_language_edges(spark):
    docs = plain.edge_docs(spark)
    net = language.train(["a", "b"], *_two_languages())
    got = by_id(language.identify(pick(docs, "doc_id", "text"), net, keep=("doc_id", "text")).collect())
    assert len(got) == docs.count()
    for r in got:
        unknown = r["text"] is None or not any(c.isalpha() for c in r["text"])
        assert (r["lang_pred"] == "und") == unknown and (r["score"] == 0) == unknown
    none = language.fit(empty(spark))
    assert {r["lang_pred"] for r in language.identify(pick(docs, "doc_id", "text"), none).collect()} == {"und"}


def _two_languages():
    texts = [b"kok kek kik " * 10, b"mum mam mim " * 10] * 30
    cut, _ = language.windows(np.frombuffer(b"".join(t[:120] for t in texts), np.uint8), np.arange(61) * 120)
    return cut, np.array([0, 1] * 30)


def test_windows_cover_every_gram():
    data = np.frombuffer(bytes(range(97, 123)) * 40, np.uint8)
    for n in (0, 1, 3, 4, 125, 127, 128, 129, 253, 254, 1000):
        cut, count = language.windows(data[:n], np.array([0, n]))
        grams = {bytes(w[i : i + 4]) for w in cut.T for i in range(language.LENGTH - 3)}
        plain_classes = bytes(language._CLASS[data[:n]])
        assert {plain_classes[i : i + 4] for i in range(n - 3)} <= grams and len(count) == 1


def test_summed_tables_equal_filters():
    cut, wanted = _two_languages()
    net = language.train(["a", "b"], cut, wanted)
    some = cut[:, :5]
    pooled = [sum(net.taps[w][j][some[j : language.LENGTH - w + 1 + j]] for j in range(w)).max(axis=0) for w in language.WIDTHS]
    want = language._softmax(language._logits(net, np.concatenate(pooled, axis=1)))
    assert np.allclose(language.probabilities(net, language.tables(net), some), want, atol=1e-5)
    assert (language.probabilities(net, language.tables(net), cut).argmax(axis=1) == wanted).all()


# SimHash


@pytest.mark.parametrize("lower", [False, True])
@pytest.mark.parametrize("which", ["edge", "table"])
def test_simhash(spark, which, lower):
    docs = plain.edge_docs(spark) if which == "edge" else plain.documents(spark)
    rows = pairs(docs)
    prints = [plain.fingerprint(plain.fold(t) if lower else t) for _, t in rows]
    roots = plain.groups(prints)
    want = []
    for (d, _), p, root in zip(rows, prints, roots, strict=True):
        ids = [i for (i, _), r in zip(rows, roots, strict=True) if r == root and i is not None]
        want.append((str(d), p, str(min(ids, default=None))))
    got = simhash.near_duplicates(pick(docs, "doc_id", "text"), lower=lower).collect()
    assert sorted((str(r["doc_id"]), r["print"] % 2**64, str(r["component_id"])) for r in got) == sorted(want)
    kept = simhash.one_of_each(docs, lower=lower)
    assert kept.columns == docs.columns and kept.count() == len(set(roots))


@pytest.mark.parametrize("most", [2, 16, 1024])
def test_trie_join_at_any_cut(spark, most):
    rng = np.random.default_rng(3)
    center = rng.integers(0, 2**63, 1, np.uint64)[0]
    cluster = [int(center)]
    for _ in range(300):  # a ball of near fingerprints, split deep in the trie
        cluster.append(cluster[rng.integers(len(cluster))] ^ (1 << int(rng.integers(64))))
    prints = np.unique(np.array(cluster + [int(x) for x in rng.integers(0, 2**63, 300, np.uint64)] + [0, 1, 2**64 - 1], np.uint64))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "print long")
    found = {(r["a"], r["b"]) for r in simhash.links(frame, most).collect()}
    at = {int(p): i for i, p in enumerate(prints.view(np.int64))}
    label = np.arange(len(prints))
    simhash._settle(label, *(np.array([at[x[k]] for x in found], np.int64) for k in (0, 1)))
    assert label.tolist() == plain.groups(prints)


def test_simhash_of_no_documents(spark):
    assert simhash.near_duplicates(pick(empty(spark), "doc_id", "text")).collect() == []
    assert simhash.one_of_each(empty(spark)).collect() == []


def test_components(spark):
    from slowtide.llm.components import components

    chain = [(i, i + 1) for i in range(200)] + [(500, 600), (600, 700), (700, 500), (9, 9)] + [(1000, k) for k in range(1001, 1300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    want = {i: 0 for i in range(201)} | {i: 500 for i in (500, 600, 700)} | {1000 + i: 1000 for i in range(300)}
    assert got == want


# token ids


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_library(name):
    texts = ["", " ", "a", " lead", "trail ", "a  b", "don't we'll x's", "end.\nNext, word", "a\n\nb", "x \n y", "12 3a b4", "Ünïcode ñ ß", "é x", "<|endoftext|> z", " a b ", "ΑΣ σ", "日本 語", "a.b,c d-e", plain.LONG[:5000]]
    coder = tokens.Encoder(public_tokenizers.path(name))
    for _ in range(2):
        ids, ends = coder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == plain.encodings(texts, name)


def test_encoder_forgets(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 3)
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    for texts in (["a b c d e", "f g"], ["a x", "y z w"], ["b", ""]):
        ids, ends = coder.encode(pa.array(texts))
        assert [x.tolist() for x in np.split(ids, ends[:-1])] == plain.encodings(texts, "byte_bpe_50k.json")


def test_a_chunk_costs_the_same_beside_many_known_parts(monkeypatch):
    coder = tokens.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(coder, "_encoded", lambda parts: [[1]] * len(parts))

    def seconds(texts, times=1):
        began = time.process_time()
        for _ in range(times):
            coder.encode(pa.array(texts))
        return time.process_time() - began

    learning = seconds([" ".join(map("".join, itertools.product(string.ascii_lowercase, repeat=4)))])
    assert seconds(["some words", "of few"], times=20) < learning


@pytest.mark.parametrize("bits", [1, 5, 8, 13, 16, 17, 24, 31, 32])
def test_bit_packing(bits):
    rng = np.random.default_rng(bits)
    ids = rng.integers(0, 2**bits, 10_001, np.uint32)
    ends = np.array([0, 3, 5000, 10_001])
    shard = binary.Shard(binary.image([4, None, -7, 9], ids, ends, bits))
    assert shard.doc_ids.tolist() == [4, 0, -7, 9] and shard.nulls.tolist() == [False, True, False, False]
    for a, b in ((0, 10_001), (0, 0), (4095, 4097), (10_000, 10_001), (17, 9000)):
        assert (shard.ids(a, b) == ids[a:b]).all()
    assert (shard.document(2) == ids[3:5000]).all() and len(shard.document(0)) == 0
    assert len(binary.pack(ids, bits)) == -(-len(ids) * bits // 8)
    with pytest.raises(ValueError):
        binary.Shard(binary.image([4], ids[:5], np.array([5]), bits)[:-1])


def test_width():
    assert [binary.width(n) for n in (1, 2, 3, 256, 257, 50_257, 65_536, 65_537)] == [1, 1, 2, 8, 9, 16, 16, 17]


@pytest.mark.parametrize("which", ["edge", "table"])
def test_binary_ids(spark, which, tmp_path, monkeypatch):
    docs = plain.edge_docs(spark) if which == "edge" else plain.documents(spark)
    shards = binary.write_shards(pick(docs, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    got = sorted(binary.read_shards(shards).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted((d for d, _ in pairs(docs)), key=lambda d: (d is not None, d or 0))
    assert [r["start"] for r in got] == np.cumsum([0] + [r["n_tokens"] for r in got])[:-1].tolist()
    rows = pairs(docs)
    want = sorted((str(d), len(e) + 1, plain.crc([*e, 2])) for (d, _), e in zip(rows, plain.encodings([t for _, t in rows], "byte_bpe_50k.json"), strict=True))
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["ids_crc32"]) for r in got) == want
    binary.save(str(tmp_path / "shard"), bytes(shards.first()["image"]))
    assert binary.open_shard(str(tmp_path / "shard")).n_ids == shards.first()["n_ids"]


def test_binary_ids_of_no_documents(spark):
    shards = binary.write_shards(pick(empty(spark), "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
    assert binary.read_shards(shards).collect() == []


# packing


@pytest.mark.parametrize("which", ["edge", "table"])
def test_packing(spark, which):
    docs = plain.edge_docs(spark) if which == "edge" else plain.documents(spark)
    rows = pairs(docs)
    want = []
    for (d, _), e in zip(rows, plain.encodings([t for _, t in rows], "word_bpe_49k.json"), strict=True):
        e = [*e, 0]
        want += [(str(d), k, a, len(e[a : a + 2048]), plain.crc(e[a : a + 2048])) for k, a in enumerate(range(0, len(e), 2048))]
    cut = packing.pieces(pick(docs, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), with_ids=True)
    got = packing.pack(cut).collect()
    assert sorted((str(r["doc_id"]), r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == sorted(want)
    assert all(plain.crc(r["ids"]) == r["ids_crc32"] for r in got)
    sequences = {}
    for r in got:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == np.cumsum([0] + [n for _, n in places])[:-1].tolist() and sum(n for _, n in places) <= 2048
    total = sum(r["length"] for r in got)
    assert len(sequences) <= -(-total // 2048) + 1


def test_packing_of_no_documents(spark):
    assert packing.pack(packing.pieces(pick(empty(spark), "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_plan_uses_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    counts = np.zeros(2049, np.int64)
    lengths = [rng.integers(1, 2049, 5000), rng.integers(1100, 1400, 300), np.full(4000, 700), rng.integers(1, 200, 20_000)][seed]
    np.add.at(counts, lengths, 1)
    made = packing.plan(counts)
    used = np.zeros(2049, np.int64)
    for pattern, times in made:
        assert sum(pattern) <= 2048 and times > 0
        for n in pattern:
            used[n] += times
    assert (used == counts).all()
    n = sum(t for _, t in made)
    bound = max(-(-int(lengths.sum()) // 2048), int((lengths > 1024).sum()), -(-int((lengths > 682).sum()) // 2))
    assert n <= bound * 1.01 + 1


def test_least_squares_meets_a_feasible_histogram():
    counts = np.zeros(2049, np.int64)
    counts[[1000, 1048, 500, 524, 1024]] = [70, 70, 0, 0, 40]
    found = packing.patterns(counts)
    x = packing.repeats(found, counts)
    used = np.zeros(2049)
    for pattern, times in zip(found, x, strict=True):
        for n in pattern[pattern > 0]:
            used[n] += times
    assert np.allclose(used[counts > 0], counts[counts > 0], rtol=1e-3) and (x >= 0).all()


# licenses


def test_license_edges(spark):
    docs = plain.edge_docs(spark)
    con = duckdb.connect()
    rows = pick(docs, "doc_id", "text").toPandas()
    rows["doc_id"] = rows["doc_id"].astype("Int64")
    con.register("documents", rows)
    assert compare(licenses.scan(docs), con, licenses.CHECK) is None
    assert licenses.scan(empty(spark)).collect() == []


def test_license_spans(spark):
    mit = next(words for label, _, _, words in licenses.TEMPLATES if label == "mit").split()
    broken = mit[:30] + ["inserted", "words"] + mit[30:70] + mit[73:]
    texts = [
        "x y " + " ".join(mit).upper() + " z", " ".join(broken), " ".join(mit[:40]),
        "licensed under the GNU general public license, version 2; and licensed under the gnu General Public License version 3",
        "Under the MİT license K CC BY-NC", "All rights reserved", "UNDER the MIT license! under (the) mit license",
    ]
    got = {r["doc_id"]: r for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [got[i]["labels"] for i in range(7)] == ["mit", "mit", "", "gpl-2,gpl-3", "cc-by-nc", "all-rights-reserved", "mit"]
    assert got[0]["score"] == 1 and 0.8 <= got[1]["score"] < 1 and got[2]["score"] == 0
    assert (got[6]["n_base"], got[6]["first_word"], got[6]["last_word"], got[6]["base_labels"]) == (2, 0, 4, "mit")


# SentencePiece


@pytest.fixture(scope="module")
def unigram(tmp_path_factory):
    """The model file with its type set to unigram and scores that keep in single precision."""
    pb2 = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    proto = pb2.ModelProto()
    with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as source:
        proto.ParseFromString(source.read())
    proto.trainer_spec.model_type = 1
    for piece in proto.pieces:
        if piece.type == 1:
            piece.score = max(piece.score / 1024, -60)
    path = tmp_path_factory.mktemp("model") / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    return str(path)


def test_viterbi_equals_the_library(spark, unigram):
    import sentencepiece

    library, own = sentencepiece.SentencePieceProcessor(model_file=unigram), viterbi.PieceEncoder(unigram)
    lines = [x for _, t in pairs(plain.documents(spark)) for x in (t or "").split("\n") if x] + ["  two  spaces ", "a", "naïve café", ""]
    ids, ends = own.encode(pa.array(lines))
    assert [x.tolist() for x in np.split(ids, ends[:-1])] == [library.encode(x) for x in lines]


def test_pieces_round_trip(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    docs = plain.edge_docs(spark)
    own = viterbi.PieceEncoder(path)
    got = viterbi.encode(docs, path, with_ids=True).collect()
    assert len(got) == docs.count() and all(r["round_trip"] for r in got)

    def brute(text):
        units = viterbi._UNITS.findall("▁" + text.replace(" ", "▁")) if text else []
        return [i for u in units for i in own.pieces.single(u)]

    want = sorted((str(d), brute(t or "")) for d, t in pairs(docs))
    assert sorted((str(r["doc_id"]), r["ids"]) for r in got) == want
    assert all(r["n_pieces"] == len(r["ids"]) and r["ids_crc32"] == plain.crc(r["ids"]) for r in got)
    assert viterbi.encode(empty(spark), path).collect() == []


def test_every_trusted_document_fits_the_quality_model(spark):
    """With more trusted documents than any sample took, the target of a wholly trusted corpus is the corpus itself."""
    docs = spark.range(21_000).select(F.col("id").alias("doc_id"), F.format_string("word %d", F.col("id")).alias("text"))
    labels = docs.select("doc_id", F.lit(1).alias("quality"), F.lit(0).alias("toxic"))
    model = quality.fit(docs, labels)
    assert not model.ratios.any() and model.threshold == 0.0
    half = quality.fit(docs, labels.filter("doc_id % 2 = 0"))
    scores = sorted(r.score for r in quality.judge(docs.filter("doc_id % 2 = 0"), half).collect())
    assert half.threshold == scores[int(quality.LOST * len(scores))]


def test_quality_fit_moves_marked_texts_only(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.concat_ws(" ", F.lit("text"), F.col("id")).alias("text"))
    ids = spark.range(0, 8000, 40).select(F.col("id").alias("doc_id"))
    marked = quality._marked(docs, ids)
    held = {r.doc_id for r in marked.collect()}
    assert set(range(0, 4000, 40)) <= held and len(held) < 110
    assert {r.doc_id for r in quality._marked(docs, ids, 64).collect()} >= set(range(0, 4000, 40))  # a full table marks all
    assert {r.doc_id for r in quality._among(marked, ids).collect()} == set(range(0, 4000, 40))
    odd = spark.createDataFrame([(None, "a"), (40, "b"), (40, "c"), (1, "d")], "doc_id long, text string")
    assert sorted(r.text for r in quality._among(quality._marked(odd, ids), ids).collect()) == ["b", "c"]
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    assert quality._among(quality._marked(named, ids), ids).count() == 100
    # small tables take the plan of large ones: no join of the labels is a broadcast
    plan = quality._among(docs, ids)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_quality_fit_writes_no_text(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(quality, "materialize", lambda df, label: kept.append(df.columns) or materialize(df, label))
    quality.fit(plain.documents(spark), plain.documents(spark, "labels"))
    assert kept and not any("text" in columns for columns in kept)
