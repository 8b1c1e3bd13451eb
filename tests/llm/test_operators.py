"""Operators without SQL against plain versions; formats by round trip; models by held-out accuracy."""

import gzip
import io
import math
import random
import re
import time
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow.fs as fs
import pytest

import corpus_pipeline
from tallyframe.llm import decontamination, mixing, neardup, neighbours, pii, quality, secrets, tokens, toxicity, warc
from tallyframe.llm.components import components

SF = "/root/testdata/sf0.001"
DOCS = "doc_id:long text:string"


def plain_components(sets, percent=80):
    """Component of each place: smallest place reachable."""
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in combinations(range(len(sets)), 2):
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return [find(x) for x in range(len(sets))]


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or {tuple(words)}


@pytest.fixture(scope="module")
def texts():
    """Originals, exact copies, edited copies at all distances, tiny texts, and a passage that many share."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    passage = rng.choices(words, k=60)
    out = []
    for _ in range(40):
        base = rng.choices(words, k=rng.choice([3, 12, 50, 150])) + (passage if rng.random() < 0.4 else [])
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 8))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append(" ".join(copy))
        out += [" ".join(base).upper()] * rng.choice([0, 0, 2])
    out += ["a", "A", "a b", "b a", "", None, "  \n", "a b c", "a  b\tc"]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_all_pairs(make, texts, size):
    found = neardup.near_duplicates(make(DOCS, list(enumerate(texts))), "doc_id", "text", size).collect()
    sets = [shingles(t, size) for t in texts]
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in found} == {
        i: (len(sets[i]), c, c == i) for i, c in enumerate(plain_components(sets))
    }


def test_near_duplicates_of_a_group_around_no_centre(make):
    """A chain: neighbours are alike, ends are not; and many copies of one text."""
    words = [f"v{i}" for i in range(400)]
    chain = [" ".join(words[k * 5 : k * 5 + 100]) for k in range(40)]
    found = neardup.near_duplicates(make(DOCS, [(i, t) for i, t in enumerate(chain + chain[:1] * 500)]), "doc_id", "text", 5).collect()
    assert {r["component_id"] for r in found} == {0}


def test_keep_one_without_ids_and_with_repeated_rows(make):
    rows = [(None, "a b c d e f"), (None, "a b c d e f"), (3, "x y z"), (3, "x y z"), (4, "X Y z"), (None, ""), (None, None), (7, "q")]
    kept = neardup.keep_one(make(DOCS, rows), "doc_id", "text").collect()
    assert sorted(map(repr, map(tuple, kept))) == sorted(map(repr, [rows[0], rows[2], rows[5], rows[6], rows[7]]))


def test_components_of_chains_and_hubs(make):
    links = [(i, i + 1) for i in range(50)] + [(100, i) for i in range(101, 200)] + [(300, 300), (401, 400), (402, 401)]
    got = {r["node"]: r["root"] for r in components(make("a:long b:long", links)).collect()}
    assert len({got[i] for i in range(51)}) == 1 and len({got[i] for i in range(100, 200)}) == 1
    assert len({got[400], got[401], got[402]}) == 1 and len(set(got.values())) == 3 and 300 not in got


def test_estimate_keeps_pairs_at_the_threshold():
    rng = np.random.default_rng(3)
    for n in (5, 20, 100, 1000, 5000):
        for _ in range(60):
            both = rng.integers(0, 1 << 63, n, np.uint64)
            extra = rng.integers(0, 1 << 63, n // 4, np.uint64)
            a, b = np.unique(both), np.unique(np.concatenate([both, extra]))
            x, y = neardup.sketch(a)[None], neardup.sketch(b)[None]
            assert neardup.may_reach(x, y, np.array([len(a)]), np.array([len(b)]), 80)[0]
            assert neardup.sketch(a).dtype == np.dtype("<u2")


def test_recall_of_neighbours(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()
    ids = np.array([r["vec_id"] for r in rows])
    vectors = np.array([r["embedding"] for r in rows], float)
    found = {}
    for r in neighbours.op7_nearest_vectors(spark, "/root/testdata/sf0.01").collect():
        found.setdefault(r["query_id"], []).append(r)
    hits = 0
    for q in np.flatnonzero(ids % 100 == 0):
        distance = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        distance[q] = np.inf
        best = np.lexsort((ids, distance))[:10]
        mine = sorted(found[ids[q]], key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == list(range(1, 11))
        assert [(r["score"], r["vec_id"]) for r in mine] == sorted((r["score"], r["vec_id"]) for r in mine)
        hits += len({r["vec_id"] for r in mine} & set(ids[best].tolist()))
    assert hits >= 0.9 * 10 * len(found)


def test_neighbours_of_ragged_vectors(make):
    rng = np.random.default_rng(2)
    rows = [(i, list(rng.standard_normal(8))) for i in range(300)] + [(1000 + i, [1.0] * 300) for i in range(9)] + [(2000, [1.0])]
    got = neighbours.nearest(make("vec_id:long vector:vector", rows), "vec_id", "vector", lambda i: i % 100 == 0, k=10).collect()
    assert len(got) == 30 and {r["query_id"] for r in got} == {0, 100, 200} and max(r["vec_id"] for r in got) < 300


def test_recall_by_the_share_of_rows_alone(make):
    rng = np.random.default_rng(6)
    vectors = (rng.standard_normal((200, 16))[rng.integers(0, 200, 20_000)] * 3 + rng.standard_normal((20_000, 16))).astype(np.float32)
    rows = make("vec_id:long vector:vector", list(enumerate(vectors.tolist())))
    got = neighbours.nearest(rows, "vec_id", "vector", lambda i: i % 400 == 0, k=10, least=0).collect()
    true, exact = 0, vectors.astype(float)
    for q in range(0, 20_000, 400):
        distance = ((exact - exact[q]) ** 2).sum(1)
        distance[q] = np.inf
        true += len(set(np.argsort(distance)[:10]) & {r["vec_id"] for r in got if r["query_id"] == q})
    assert len(got) == 500 and true / 500 >= 0.9


def test_neighbours_of_identical_vectors(make):
    rows = [(i, [1.0, 2.0, 0.5]) for i in range(3000)] + [(5000 + i, [float(i), 1.0, 1.0]) for i in range(20)]
    found = neighbours.nearest(make("vec_id:long embedding:vector", rows), "vec_id", "embedding", lambda i: i == 2000, k=5).collect()
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(found, key=lambda r: r["rank"])] == [(k + 1, k, 0.0) for k in range(5)]


def test_forest_finds_all_that_share_a_prefix():
    rng = np.random.default_rng(0)
    vectors = rng.standard_normal((500, 8))
    forest = neighbours.Forest(vectors, trees=3, bits=20)
    codes = forest.codes(vectors)
    shard = neighbours.Shard(forest, np.arange(500), vectors)
    counts = shard.counts(codes[:5])
    for q in range(5):
        for length in range(21):
            assert counts[q, length] == (codes >> (20 - length) == codes[q] >> (20 - length)).sum()


def test_fm_index_equals_a_plain_search():
    rng = random.Random(1)
    for _ in range(40):
        letters = "abcdefgh"[: rng.choice([1, 2, 3, 6])]
        texts = [" ".join(rng.choice(letters + "z") for _ in range(rng.choice([0, 3, 200, 800]))) for _ in range(3)]
        items = [(" ".join(rng.choice(letters) for _ in range(rng.choice([1, 3, 10, 10]))), str(i)) for i in range(rng.randint(0, 20))]
        counts, ranges, found = decontamination.find_in_texts(texts, decontamination.Phrases(items), rng.choice([20, 100, 10**6]))
        for text, n, spans, names in zip(texts, counts, ranges, found, strict=True):
            words, hit, held = text.split(), set(), set()
            for phrase, item in items:
                p = phrase.split()
                for k in range(len(words) - len(p) + 1):
                    if words[k : k + len(p)] == p:
                        hit.update(range(k, k + len(p)))
                        held.add(item)
            assert (n, set(names)) == (len(words), held)
            assert hit == {x for a, b in spans for x in range(a, b)}


def test_contamination_in_blocks_and_spans(make):
    docs = make(DOCS, [(1, "Say: The Lazy-Dog sleeps é now"), (2, "nothing")])
    items = make("item_id:long text:string", [(1, "lazy dog"), (2, "sleeps É"), (3, "sleeps é"), (4, "lazy  dog")])
    for block in (1, 100):
        one = decontamination.find_contamination(docs, "text", items, "item_id", "text", block=block).where("row.doc_id = 1").first()
        assert one["items"] == ["1", "3", "4"] and one["n_hit"] == 4
        assert [(s["start"], s["end"]) for s in one["spans"]] == [(9, 26)]


def test_wavelet_ranks():
    values = np.random.default_rng(2).integers(0, 13, 1000)
    matrix = decontamination.WaveletMatrix(values, 4)
    at = np.arange(1001)
    for symbol in range(13):
        assert (matrix.rank(np.full(1001, symbol), at) == np.concatenate([[0], np.cumsum(values == symbol)])).all()


def test_encoder_equals_the_library():
    import public_tokenizers

    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["", " ", "\n", "AB. ab. CD, x.. y., z. ÀÉ. <|ENDOFTEXT|> é. ", "İ Σας ΑΣ ’s", "Don'T l'été x²y½ ªº µ× ça!! ß.. 12ab_3", "<|endoftext|>x\x85\xa0z \x1f", "é́ ſ K 中文 'S don't\ta\r\n\n x", "a" * 5000]
    for _ in range(2):
        ids, counts = encoder.encode(odd)
        parts = np.split(ids, np.cumsum(counts)[:-1])
        assert [p.tolist() for p in parts] == [x.ids for x in encoder.tokenizer.encode_batch(odd, add_special_tokens=False)]


def test_encoder_equals_the_library_on_mixed_pieces(monkeypatch):
    import public_tokenizers

    rng = np.random.default_rng(5)
    some = ["a", "the", "s", "'s", "'", "l", "'re", "é", "ÿß", "È", "B", ".", "..", "<", "|", "<|", "7", "½", "µ", "ª", "\xa0", "\t", "İ", "中", "\u0301", " ", " ", "  ", "\n"]
    texts = ["".join(rng.choice(some, rng.integers(0, 40))) for _ in range(3000)]
    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    monkeypatch.setattr(tokens, "REMEMBERED", 1000)
    for at in range(0, len(texts), 500):
        ids, counts = encoder.encode(texts[at : at + 500])
        expected = encoder.tokenizer.encode_batch(texts[at : at + 500], add_special_tokens=False)
        assert [p.tolist() for p in np.split(ids, np.cumsum(counts)[:-1])] == [x.ids for x in expected]
    assert [x.tolist() for x in encoder.encode([])] == [[], []]


def test_encoder_meets_each_piece_of_a_batch_once():
    import public_tokenizers

    class Counted(dict):
        asked = 0

        def __getitem__(self, piece):
            Counted.asked += 1
            return super().__getitem__(piece)

        def get(self, piece, other=None):
            Counted.asked += 1
            return super().get(piece, other)

    encoder = tokens.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    texts = ["one two, l'été one\n" * 500] * 20
    first = encoder.encode(texts)
    encoder.known = Counted(encoder.known)
    again = encoder.encode(texts)
    assert all((a == b).all() for a, b in zip(first, again, strict=True))
    # "one", "two,", "l'été" and the empty piece after the last line.
    assert Counted.asked <= 4


@pytest.mark.parametrize("planes", ["byte", "bit"])
def test_planes_round_trip(spark, make, tmp_path, planes):
    import public_tokenizers

    rows = [(3, "b c " * 300), (1, "a"), (2, None), (None, "last"), (1, "a")]
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = f"file://{tmp_path}/out"
    manifest = tokens.write_tokens(make(DOCS, rows), folder, "doc_id", "text", path, block=128, planes=planes)
    got = sorted(tokens.read_tokens(manifest, folder).collect(), key=lambda r: r["start"])
    encoder = tokens.Encoder(path).tokenizer
    expected = [encoder.encode(t or "", add_special_tokens=False).ids + [2] for t in ["a", "a", None, "b c " * 300, "last"]]
    assert [r["doc_id"] for r in got] == [1, 1, 2, 3, None]
    assert [np.frombuffer(r["ids"], "<u4").tolist() for r in got] == expected
    assert [r["start"] for r in got] == np.cumsum([0] + [len(e) for e in expected[:-1]]).tolist()


def test_token_query_equals_the_library(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    docs = sorted(spark.read.parquet(f"{SF}/documents.parquet").collect(), key=lambda r: r["doc_id"])
    tokenizer, start, expected = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0, []
    for r in docs:
        ids = tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2]
        expected.append((r["doc_id"], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, tokens.op5_token_planes(spark, SF).collect())) == expected


def test_archive_round_trip_and_reruns(spark, make, tmp_path):
    page = "<p>é" + "same " * 40
    rows = [(3, "u", page), (2, None, page), (None, "v\r\nw", page), (4, "x y", "small"), (5, "y", "small"), (6, "z", None)] + [(i, "u", f"{i} " * 400) for i in range(10, 60)]
    digests = []
    for run in "ab":
        folder = f"file://{tmp_path}/{run}"
        manifest = warc.write_archive(make("page_id:long url:string html:string", rows), folder, "page_id", "url", "html", roll_bytes=3000)
        digests.append(sorted((r["file"], r["sha256"]) for r in manifest.collect()))
        got = warc.read_archive(manifest, folder).collect()
    assert digests[0] == digests[1] and len(digests[0]) > 3
    files, path = fs.FileSystem.from_uri(folder)
    names = [f.base_name for f in files.get_file_info(fs.FileSelector(path)) if f.is_file]
    assert sorted(n for n in names if not n.startswith(".") and n.endswith(".gz")) == [n for n, _ in digests[1]]
    assert not [n for n in names if n.endswith(".tmp")]
    by_id = {r["record_id"]: r for r in got}
    assert len(got) == len(rows) and by_id[3]["record_type"] == by_id[None]["record_type"] == "revisit"
    assert by_id[3]["refers_to"] == by_id[None]["refers_to"] == 2 and bytes(by_id[2]["payload"]).decode() == page
    assert by_id[4]["record_type"] == by_id[5]["record_type"] == by_id[6]["record_type"] == "response"
    data = files.open_input_stream(f"{path}/{digests[1][0][0]}", compression=None).read()
    assert gzip.GzipFile(fileobj=io.BytesIO(data)).readline() == b"WARC/1.1\r\n"


def pages_of(spark, rows, parts):
    made = spark.range(rows).repartition(parts)
    page = warc.F.concat(warc.F.lit("<p>"), warc.F.repeat(warc.F.sha2(warc.F.col("id").cast("string"), 256), 4))
    return made.select((warc.F.col("id") * 7 % 60_013).alias("page_id"), warc.F.lit("http://x").alias("url"), page.alias("html"))


def test_archives_of_60_000_pages_are_equal_whatever_the_partitions(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "READ_BYTES", 1 << 20)
    kept = spark.conf.get("spark.sql.shuffle.partitions")
    files = []
    try:
        for shuffle, parts in ((32, 3), (5, 11)):
            spark.conf.set("spark.sql.shuffle.partitions", shuffle)
            folder = f"file://{tmp_path}/{shuffle}"
            pages = pages_of(spark, 60_000, parts)
            manifest = warc.write_archive(pages, folder, "page_id", "url", "html", roll_bytes=200_000, shard_bytes=1 << 20)
            files.append(sorted(tuple(r) for r in manifest.collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", kept)
    assert files[0] == files[1] and sum(r[2] for r in files[0]) == 60_000
    # Shards are even, follow each other, and are read back by as many tasks as their bytes warrant.
    sizes = Counter()
    for shard, _, records, _, _ in files[0]:
        sizes[shard] += records
    assert len(sizes) >= 10 and max(sizes.values()) < 3 * 60_000 / len(sizes)
    back = warc.read_archive(manifest, folder, payloads=False)
    ends = back.groupBy(warc.F.spark_partition_id()).agg(warc.F.min("record_id"), warc.F.max("record_id"), warc.F.count("*")).collect()
    ends = sorted(tuple(r)[1:] for r in ends)
    assert sum(n for _, _, n in ends) == 60_000 and all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert len(ends) >= 0.7 * sum(r[3] for r in files[0]) / (1 << 20)


def test_ledger_scans_repeated_rows_once(spark, make, tmp_path):
    rows = [(p, "token: abcdefgh12345") for p in "ab"] * 500 + [(None, "token: zbcdefgh12345")] * 10
    ledger = f"file://{tmp_path}/ledger"
    found = secrets.scan(make("path:string text:string", rows).repartition(4), ["path"], "text", ledger).collect()
    assert len(found) == 1010 and all(len(r["spans"]) == 1 for r in found)
    held = spark.read.parquet(ledger).groupBy("blob").count().collect()
    assert len(held) == 2 and max(r["count"] for r in held) <= 4


def test_ledger_scans_only_what_is_new(spark, make, tmp_path):
    ledger = f"file://{tmp_path}/ledger"
    secret = "token: abcdefgh12345"
    first = make("path:string text:string", [("a", secret), ("b", secret), ("c", "clean"), (None, None)])
    scanned = lambda: spark.read.parquet(ledger).count()
    found = {r["path"]: r for r in secrets.scan(first, ["path"], "text", ledger).collect()}
    assert scanned() == 3 and [s["kind"] for s in found["a"]["spans"]] == ["assign"] == [s["kind"] for s in found["b"]["spans"]]
    second = first.unionAll(make("path:string text:string", [("a", "AKIA" + "Q" * 16), ("d", "clean")]))
    found = secrets.scan(second, ["path"], "text", ledger).collect()
    assert scanned() == 4 and sorted((r["path"] or "", len(r["spans"])) for r in found) == [("", 0), ("a", 1), ("a", 1), ("b", 1), ("c", 0), ("d", 0)]
    # A new rule version runs again over all blobs, for that rule alone, and replaces the old findings.
    changed = (secrets.Rule("assign", secrets.BASE_RULES[0].pattern, 14, 2, version=2),) + secrets.RULES[1:]
    found = secrets.scan(second, ["path"], "text", ledger, changed).collect()
    assert scanned() == 8 and sum(len(r["spans"]) for r in found) == 1


def test_personal_data_scores_and_checksums(make):
    text = "my bank account GB82WEST12345698765432 and GB82WEST12345698765433; call +49 (170) 123-4567 or x@y.zz"
    spans = pii.find_personal_data(make(DOCS, [(1, text)]), "text").first()["spans"]
    assert [(s["kind"], s["text"]) for s in spans] == [("email", "x@y.zz"), ("phone", "+49 (170) 123-4567"), ("iban", "GB82WEST12345698765432")]
    assert [round(s["score"], 1) for s in spans] == [0.7, 0.8, 0.9]
    assert all(text[s["start"] : s["end"]] == s["text"] for s in spans)


def test_personal_data_of_many_matches_equals_a_plain_walk(make):
    rng = random.Random(3)
    words = ["mail", "x", "\U0001F600", "1.2.3.4", "login", "999.1.1.1", "contact", "é" * 30]
    texts = [" ".join(rng.choice([f"u{i}@ex{i % 7}.org", rng.choice(words)]) for i in range(n)) for n in (1, 40, 700, 3000)]
    found = pii.find_personal_data(make(DOCS, list(enumerate(texts))), "text").collect()
    ip = lambda m: all(int(x) <= 255 for x in m.split("."))
    for row in found:
        text, want = texts[row["row"]["doc_id"]], []
        for kind, pattern, passes in (("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", bool), ("ip", r"[0-9]+(?:\.[0-9]+){3}", ip)):
            hints, base = next((k.words, k.score) for k in pii.KINDS if k.name == kind)
            for m in re.finditer(pattern, text):
                if passes(m[0]):
                    first = max(m.start() - pii.NEARBY, 0)
                    near = text[first : first + len(m[0]) + 2 * pii.NEARBY].lower()
                    want.append((kind, m.start(), m.end(), m[0], round(base + 0.3 * any(w in near for w in hints), 1)))
        assert [(s["kind"], s["start"], s["end"], s["text"], round(s["score"], 1)) for s in row["spans"] if s["kind"] in ("email", "ip")] == want


def test_personal_data_of_a_text_with_100_000_matches(make):
    text = " ".join(f"u{i}@ex{i % 7}.org" for i in range(100_000))
    began = time.monotonic()
    spans = pii.find_personal_data(make(DOCS, [(1, text)]), "text").select(pii.F.size("spans"), pii.F.element_at("spans", -1)["end"]).first()
    assert tuple(spans) == (100_000, len(text)) and time.monotonic() - began < 60


def test_native_operators_run_no_python(spark, capsys):
    for query in (mixing.op1_mix_sources, pii.op8_personal_data):
        query(spark, SF).explain()
        assert not re.search("Python|Arrow|Pandas", capsys.readouterr().out)


def test_mix_with_one_row_and_with_equal_rows(make):
    rows = [(1, "a", 10)] * 9 + [(2, "b", 0), (3, None, 7), (4, "c", 1)]
    got = mixing.mix(make("doc_id:long source:string size:long", rows), "source", mixing.F.col("size"), ["doc_id", "source", "size"])
    got = got.select("row.source", "size", "target", "taken", "copies").collect()
    assert len(got) == len(rows) and all(r["taken"] <= 2 * r["size"] for r in got)
    taken = sum(r["taken"] for r in got if r["source"] == "a")
    target = next(r["target"] for r in got if r["source"] == "a")
    assert abs(taken - target) <= 5 and sum({r["source"]: r["target"] for r in got}.values()) == pytest.approx(1.5 * 98)


def test_label_model_finds_who_can_be_trusted():
    rng = np.random.default_rng(4)
    truth = rng.random(20_000) < 0.8
    accuracy, said = [0.97, 0.95, 0.92, 0.5], [0.9, 0.6, 0.8, 0.9]
    votes = np.stack([np.where(rng.random(20_000) < s, np.where(rng.random(20_000) < a, 1, -1) * np.where(truth, 1, -1), 0) for a, s in zip(accuracy, said)], 1)
    patterns, place, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    good = quality.label_model(patterns, counts)[place.ravel()]
    assert ((good > 0.5) == truth).mean() > 0.95


def test_quality_against_hand_made_labels(spark):
    sf = "/root/testdata/sf0.01"
    scored = quality.op9_quality(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").collect()
    clean = [r["kept"] for r in scored if r["quality"] is not None and r[3] == 1]
    junk = [r["kept"] for r in scored if r[3] == 0]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.15


def plain_shape(word):
    kind = lambda c: "A" if c.isupper() else "a" if c.isalpha() else "0" if c.isnumeric() else c
    kinds, runs = [], 0
    for i, c in enumerate(word):
        runs += i == 0 or kind(c) != kind(word[i - 1])
        if kind(c) not in kinds:
            kinds.append(kind(c))
    return "".join(kinds) + ("+" if runs > len(kinds) else "")


def test_shapes_look_at_whole_words():
    shapes = quality.Shapes()
    words = ["a", "Word", "word,", "a1b2", "a" * 100_000 + "7", "x" * 24 + "Y" * 50 + "!", "größer", "don't", "0xFF", "𝒳y", "漢字", "9" * 65]
    assert [shapes[w] for w in words] == [plain_shape(w) for w in words]
    assert shapes["a" * 100_000 + "7"] == "a0" and shapes["漢字" * 40_000] == "a"
    assert max(map(len, shapes)) <= quality.REMEMBERED


def plain_quality(texts):
    """The whole query document by document, with dictionaries: labels, posteriors, weights, scores."""
    made, given = [], []
    for t in texts:
        m, words = quality.measures(t), t.split()
        given.append(quality.votes(m))
        names = [f"{k}:{int(math.log2(v + 1) if k == 'words' else v if k == 'length' else min(v, 1) * 16)}" for k, v in m.items()]
        counts = {}
        for w in words:
            counts[plain_shape(w)] = counts.get(plain_shape(w), 0) + 1
        names += [f"shape {k}:{int(c / len(words) * 4)}" for k, c in counts.items() if c / len(words) >= 0.03]
        made.append(sorted({zlib.crc32(x.encode()) % quality.FEATURES for x in names}))
    good = [1 / (1 + math.exp(-1 - v.count(1) + 4 * v.count(-1))) for v in given]
    for _ in range(100):
        prior = [(n - sum(good) + 1) / (n + 2) if c == 0 else (sum(good) + 1) / (n + 2) for n in [len(texts)] for c in (0, 1)]
        share = {}
        for j in range(quality.LABELLERS):
            for c in (0, 1):
                said = {a: 0.5 + sum((g if c else 1 - g) for v, g in zip(given, good) if v[j] == a) for a in (-1, 0, 1)}
                share[j, c] = {a: x / sum(said.values()) for a, x in said.items()}
        fresh = []
        for v in given:
            log = [math.log(prior[c]) + sum(math.log(share[j, c][v[j]]) for j in range(quality.LABELLERS)) for c in (0, 1)]
            fresh.append(1 / (1 + math.exp(max(-50, min(50, log[0] - log[1])))))
        moved, good = max(abs(a - b) for a, b in zip(fresh, good)), fresh
        if moved < 1e-6:
            break
    rows = {t: (f, g) for t, f, g in zip(texts, made, good)}
    weights, squares = {}, {}
    used = sorted({f for fs, _ in rows.values() for f in fs} | {quality.FEATURES})
    for _ in range(200):
        gradient = {f: 1e-4 * weights.get(f, 0.0) for f in used}
        for fs, g in rows.values():
            off = 1 / (1 + math.exp(-sum(weights.get(f, 0.0) for f in [*fs, quality.FEATURES]))) - g
            for f in [*fs, quality.FEATURES]:
                gradient[f] += off / len(rows)
        for f in used:
            squares[f] = squares.get(f, 1e-8) + gradient[f] ** 2
            weights[f] = weights.get(f, 0.0) - 0.5 * gradient[f] / math.sqrt(squares[f])
    return [1 / (1 + math.exp(-sum(weights[f] for f in [*fs, quality.FEATURES]))) for fs in made]


def test_quality_query_against_a_plain_version(spark, make, tmp_path):
    rng = random.Random(8)
    some = ["Alpha", "beta,", "gamma", "delta.", "it", "is", "so", "3.14", "We", "ran"]
    texts = ["", "", "x" * 500, "{}|" * 80, "BUY NOW " * 20, "one line\n" * 30]
    texts += [" ".join(rng.choices(some, k=rng.randint(3, 60))) + "." for _ in range(80)] + ["same text, here."] * 40
    rows = [(i, t or None) for i, t in enumerate(texts)]
    make(DOCS, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: (r["quality"], r["kept"]) for r in quality.op9_quality(spark, str(tmp_path)).collect()}
    want = plain_quality(texts)
    assert [got[i][0] for i in range(len(texts))] == pytest.approx(want, abs=1e-6)
    assert [got[i][1] for i in range(len(texts))] == [w >= quality.KEEP for w in want]


def test_toxicity_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = toxicity.op10_toxicity(spark, sf).where("held_out").join(labels, "doc_id").collect()
    score, toxic = np.array([r["score"] for r in rows]), np.array([r["toxic"] for r in rows]) == 1
    auc = (score[toxic][:, None] > score[~toxic][None]).mean() + 0.5 * (score[toxic][:, None] == score[~toxic][None]).mean()
    assert auc > 0.92 and ((score >= 0.5) == toxic).mean() > 0.95


def test_risk_does_not_go_below_zero():
    rows = [np.array([i % 50]) for i in range(400)]
    positive = np.array([i % 50 < 5 and i < 200 for i in range(400)])
    weights = toxicity.nn_pu(rows, positive, 0.1, 50, rounds=500)
    score = 1 / (1 + np.exp(-(weights[:50] + weights[50])))
    assert score[:5].min() > 0.5 > score[5:].max()


def test_pipeline_stages_against_plain_versions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality", "near_duplicates", "decontamination", "mixing", "tokens"]
    stage = dict(corpus_pipeline.STAGES)
    text = lambda rows: {r["doc_id"]: r["text"] for r in rows}

    good = stage["quality"](spark, docs, SF)
    assert good.columns == docs.columns
    weights, shapes = quality.fit(docs, "text"), quality.Shapes()
    judge = lambda t: weights[quality.FEATURES] + weights[quality.features(t, quality.measures(t), shapes)].sum() >= 0
    good = good.collect()
    assert {r["doc_id"] for r in good} == {r["doc_id"] for r in docs.collect() if judge(r["text"])}

    frame = spark.createDataFrame(good, docs.schema)
    single = stage["near_duplicates"](spark, frame, SF).collect()
    order = sorted(good, key=lambda r: r["doc_id"])
    roots = plain_components([shingles(r["text"], 5) for r in order])
    assert {r["doc_id"] for r in single} == {order[c]["doc_id"] for c in set(roots)} and len(single) == len(set(roots))

    clean = stage["decontamination"](spark, spark.createDataFrame(single, docs.schema), SF).collect()
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = {" ".join(w[k : k + 10]) for i in items for w in [cut(i["text"])] for k in range(max(1, len(w) - 9)) if w}
    sizes = {w.count(" ") + 1 for w in windows}
    dirty = lambda t: any(" ".join(w[k : k + s]) in windows for w in [cut(t)] for s in sizes for k in range(len(w) - s + 1))
    assert {r["doc_id"] for r in clean} == {r["doc_id"] for r in single if not dirty(r["text"])}

    mixed = stage["mixing"](spark, spark.createDataFrame(clean, docs.schema), SF).collect()
    known, words = text(clean), lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    assert all(known[r["doc_id"]] == r["text"] for r in mixed)
    assert sum(words(r["text"]) for r in mixed) == pytest.approx(1.5 * sum(map(words, known.values())), rel=0.1)

    last = stage["tokens"](spark, spark.createDataFrame(mixed, docs.schema), SF).collect()
    assert sorted(r["doc_id"] for r in last) == sorted(r["doc_id"] for r in mixed)
    assert max(r["start"] + r["n_tokens"] for r in last) == sum(r["n_tokens"] for r in last)


def test_hash_of_the_archive_names_is_stable():
    assert warc.record_urn(1, "ab") == warc.record_urn(1, "ab") != warc.record_urn(2, "ab")


def test_toxic_words_are_told_by_all_documents(make, monkeypatch):
    # Each word is in 40 of 1,000 toxic documents, so in about two of a sample of 50.
    monkeypatch.setattr(toxicity, "POSITIVES", 50)
    monkeypatch.setattr(toxicity, "UNLABELLED", 150)
    docs = make(DOCS, [(i, f"plain prose w{i % 25}x" if i < 1000 else f"plain prose v{i % 25}x") for i in range(4000)])
    labels = make("doc_id:long toxic:int", [(i, int(i < 1000)) for i in range(0, 4000)])
    model, _ = toxicity.fit(docs, "doc_id", "text", labels, "doc_id", "toxic")
    assert set(model) >= {toxicity.hashes_of(f"w{k}x".encode())[0] for k in range(25)}
    assert not set(model) & set(toxicity.hashes_of(b"plain"))


def test_places_are_counted_once_per_text(make):
    rows = [(1, "shining shine shiny über-überall"), (2, "shining"), (None, "shiny x"), (1, ""), (4, "x " * 5000), (5, " ".join(f"w{i}" for i in range(3000)))]
    marks = make("of:long", [(1,), (5,), (7,)])
    held = make("id:long text:string", rows)
    got = toxicity.scan(held, toxicity.filter_of(marks), np.zeros(0, np.int64)).collect()
    plain = Counter(p for _, t in rows for p in {h for w in toxicity.words_of(t) for h in toxicity.hashes_of(w)})
    counts = Counter()
    for r in got:
        counts[r["place"]] += r["n"] or 0
    assert counts.pop(-1) == len(rows) and counts.pop(None) == 0 and counts == plain
    passed = [(r["id"], sorted(r["places"])) for r in got if r["places"] is not None]
    expected = [(i, sorted({h for w in toxicity.words_of(t) for h in toxicity.hashes_of(w)})) for i, t in rows if i in (1, 5)]
    assert sorted(passed) == sorted(expected)


def test_toxicity_against_a_plain_version(spark, monkeypatch):
    """Counts, choice of features, sample and scores worked out again without Spark."""
    monkeypatch.setattr(toxicity, "UNLABELLED", 150)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows, marks = docs.collect(), {r["doc_id"]: r["toxic"] for r in labels.collect() if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    places = lambda t: {h for w in toxicity.words_of(t or "") for h in toxicity.hashes_of(w)}
    train = {r["doc_id"]: places(r["text"]) for r in rows if zlib.crc32(str(r["doc_id"]).encode()) % 5}
    toxic = {i for i, mark in marks.items() if mark == 1}
    p, n = Counter(), Counter()
    for i, found in train.items():
        n.update(found)
        p.update(found if i in toxic else ())
    positives, others = len(toxic & set(train)), len(set(train) - toxic)

    def tells(x, m):
        share = (x + m) / (positives + others)
        part = lambda k, of: k * np.log(k / of) if k > 0 else 0.0
        ratio = part(x, share * positives) + part(positives - x, (1 - share) * positives) + part(m, share * others) + part(others - m, (1 - share) * others)
        return 2 * ratio > 4.5**2

    seen = sorted(h for h in n if n[h] >= toxicity.RARE and tells(p[h], n[h] - p[h]))
    by_hash = {r["id"]: r["h"] for r in docs.selectExpr("doc_id as id", "xxhash64('sample', doc_id) as h").collect()}
    drawn = sorted(set(train) - toxic, key=by_hash.get)[:150]
    sample = sorted((toxic & set(train)) | set(drawn))
    found = [np.array([k for k, h in enumerate(seen) if h in train[i]], np.int64) for i in sample]
    weights = toxicity.nn_pu(found, np.array([i in toxic for i in sample]), len(toxic) / len(marks), len(seen))
    z = {r["doc_id"]: weights[-1] + sum(weights[k] for k, h in enumerate(seen) if h in places(r["text"])) for r in rows}
    got = {r["doc_id"]: r["score"] for r in toxicity.op10_toxicity(spark, SF).collect()}
    assert got == pytest.approx({i: 1 / (1 + np.exp(-np.clip(x, -40, 40))) for i, x in z.items()}, abs=1e-9)


def test_a_repeated_id_leaves_the_others_in_the_toxic_sample(make, monkeypatch):
    monkeypatch.setattr(toxicity, "POSITIVES", 10)
    monkeypatch.setattr(toxicity, "UNLABELLED", 30)
    # The ids of smallest hash, which the sample draws first.
    first = [r[0] for r in make("id:long", [(i,) for i in range(1000)]).selectExpr("id", "xxhash64('sample', id) as place").orderBy("place").limit(21).collect()]
    rows = [(first[0], f"plain prose {i}") for i in range(400)] + [(i, "plain prose") for i in first[1:]] + [(i, "vile prose") for i in range(1000, 1020)]
    labels = make("doc_id:long toxic:int", [(i, int(i >= 1000)) for i in [*first[1:], *range(1000, 1020)]])
    model, _ = toxicity.fit(make(DOCS, rows), "doc_id", "text", labels, "doc_id", "toxic")
    assert model[toxicity.hashes_of(b"vile")[0]] > 0.5


def test_copies_do_not_shrink_the_quality_sample(make, monkeypatch):
    rows = [(i, f"Text number {i} is here. It has some words.") for i in range(300)] + [(i, "A copy. It is long enough.") for i in range(300, 3000)]
    sizes = []
    monkeypatch.setattr(quality, "train_linear", lambda rows, target: sizes.append(len(rows)))
    quality.fit(make(DOCS, rows), "text", train_rows=200)
    assert sizes == [200]
