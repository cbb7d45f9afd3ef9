import hashlib
import os
import random
import zlib
from collections import Counter
from math import log10

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagloom.llm import common as C
from tagloom.llm import components, decontamination, jaccard_join, language_id, lm_scoring, media_png, mixing, queries, quality, sharding, token_counts, warc_zstd

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, row string, node string, size string, `bytes` string"
needs_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the test tables")


def words(seed, n, vocabulary=400):
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls, empty, blank, very long and repeated texts, repeated rows, and columns that clash."""
    long = words(99, 30000, 3000)
    texts = [None, "", " \t\n", "one", "a b c d e", words(1, 80), words(1, 80), words(2, 60), words(2, 60) + " tail", long, "ünï çødé ÀB", "x" * 5000]
    data = [(i, t, ["en", "fr", None][i % 3], ["a", None, "b"][i % 3], None if t is None else len(t), "r", "n", "s", "b") for i, t in enumerate(texts)]
    data += [data[5], data[5], (None, words(1, 80), None, None, None, None, None, None, None), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(data, DOCS).repartition(3).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], DOCS)


def tokens(text):
    return (text or "").encode().lower().split()


def part(i, mod):
    return -1 if i is None else zlib.crc32(str(i).encode()) % mod


# ---------------------------------------------------------------- 1


def test_lm_base_scores_against_brute_force(docs, nothing):
    got = lm_scoring.score_corpus(docs).collect()
    source = docs.collect()
    train = Counter()
    for r in source:
        if part(r["doc_id"], 7) != 2:
            train.update([*tokens(r["text"]), b"\0end"])
    n, v = sum(train.values()), len(train)
    want = sorted((str(r["doc_id"]), len(tokens(r["text"])) + 1, sum(train[w] > 0 for w in [*tokens(r["text"]), b"\0end"]), round(sum(log10((train[w] + 1) / (n + v + 1)) for w in [*tokens(r["text"]), b"\0end"]), 6)) for r in source)
    assert sorted((str(r["doc_id"]), r["n_tokens"], r["n_known"], round(r["base_score"], 6)) for r in got) == want
    assert {r["train_tokens"] for r in got} == {n} and all(r["score"] < 0 for r in got)
    assert all(r["held_out"] == (part(r["doc_id"], 7) == 2) for r in got)
    assert lm_scoring.score_corpus(nothing).count() == 0


def test_lm_scores_against_brute_force(spark, monkeypatch):
    """Scores from the fitted weights, and the weights against EM over single tokens without a grid."""
    draw, fitted = random.Random(4), []
    fit = lm_scoring.fit_weights
    monkeypatch.setattr(lm_scoring, "fit_weights", lambda *a: fitted.append(fit(*a)) or fitted[-1])
    data = [(f"d{i}", " ".join(f"w{min(draw.randrange(1, 60), draw.randrange(1, 60))}" for _ in range(draw.randrange(0, 60)))) for i in range(300)]
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score_corpus(spark.createDataFrame(data, "doc_id string, text string").repartition(4)).collect()}

    def model(of):
        one, two, ctx = Counter(), Counter(), Counter()
        for i, t in data:
            if part(i, 7) in of:
                w = ["<s>", *t.split(), "</s>"]
                one.update(w[1:]), two.update(zip(w, w[1:])), ctx.update(w[:-1])
        return one, two, ctx, sum(one.values()), len(one)

    def estimates(t, m):
        one, two, ctx, n, v = m
        w = ["<s>", *t.split(), "</s>"]
        for a, b in zip(w, w[1:]):
            # a context's count is that of its word or, at the start, of texts
            c = ctx[a] if a == "<s>" else one[a]
            yield (c.bit_length() if c else 0), (1 / (v + 1), one[b] / n, two[a, b] / c if c else 0.0)

    kept = model({-1, 0, 1, 4, 5, 6})
    tokens_ = [x for i, t in data if part(i, 7) == 3 for x in estimates(t, kept)]
    k, f = np.array([x[0] for x in tokens_]), np.array([x[1] for x in tokens_])
    exact = lm_scoring.mixture_weights(k, f, np.ones(len(k)))
    weights = fitted[0]
    often = np.bincount(k, minlength=65) > 100
    assert np.abs(weights - exact)[often].max() < 0.05
    full = model({-1, 0, 1, 3, 4, 5, 6})
    for i, t in data:
        assert abs(got[i] - sum(log10(weights[b] @ np.array(e)) for b, e in estimates(t, full))) < 1e-6


@pytest.mark.parametrize("types", [10**4, 10**10])
def test_lm_grid_holds_at_any_size(types):
    total = 50 * types
    cells = lm_scoring.grid_cells(total)
    ratios = np.array([1.0, 0.5, 1e-3, 1 / total])
    back = lm_scoring.grid_value(lm_scoring.grid_step(ratios, cells), cells)
    assert (np.abs(np.log2(back / ratios)) <= 0.5 / lm_scoring.GRID + 1e-9).all()
    two = lm_scoring.grid_step(np.array([0.5, 0.0]), cells)
    one = lm_scoring.grid_step(np.array([1e-3, 1e-3]), cells)
    found, n = (3 * cells + two) * cells + one, np.array([60.0, 40.0])
    k, f = np.full(2, 3), np.array([[1 / (types + 1), 1e-3, 0.5], [1 / (types + 1), 1e-3, 0.0]])
    assert np.abs(lm_scoring.fit_weights(found, n, types, total) - lm_scoring.mixture_weights(k, f, n)).max() < 0.01


def test_lm_distribution_sums_to_one():
    cells = lm_scoring.grid_cells(5000)
    found = np.array([(3 * cells + 30) * cells + 30, (2 * cells) * cells + 30])
    weights = lm_scoring.fit_weights(found, np.array([50.0, 30.0]), 1000, 5000)
    assert np.allclose(weights.sum(1), 1) and (weights >= 0).all() and weights[0, 2] == 0
    assert weights[3, 2] > 0.3 > weights[2, 2]  # where bigrams were never seen they get no say


@needs_tables
def test_lm_beats_the_base_on_held_out_text(spark):
    got = lm_scoring.score_corpus(C.table(spark, SF, "documents")).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert got[0] > got[1]


# ---------------------------------------------------------------- 2


@needs_tables
def test_quality_on_labelled_documents(spark):
    sf = SF.replace("0.001", "0.01")
    found = quality.classify(C.table(spark, sf, "documents"), C.table(spark, sf, "labels")).select("row.doc_id", "keep")
    rows = found.join(C.table(spark, sf, "labels"), "doc_id").groupBy((F.col("quality") * (1 - F.col("toxic"))).alias("good")).agg(F.avg(F.col("keep").cast("int"))).collect()
    kept = dict(map(tuple, rows))
    assert kept[1] > 0.97 and kept[0] < 0.5


def test_quality_edges(spark, docs, nothing):
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 0), (7, 1, None), (None, 1, 0), (9, None, 0), (11, 0, 0)], "doc_id long, quality int, toxic int")
    found = quality.classify(docs, labels)
    assert found.count() == docs.count() and found.where("score < 0 or score > 1").count() == 0
    assert quality.good_documents(docs, labels.limit(0)).count() == docs.count()
    assert quality.good_documents(nothing, labels).columns == nothing.columns


# ---------------------------------------------------------------- 3


def test_warc_round_trip(spark, tmp_path):
    big, other = "<p>é</p>" * 300, "<i>x</i>" * 200
    data = [(1, "http://a/", big), (2, "http://b/", big), (3, None, big), (4, "u", "short"), (5, "u", "short"), (6, None, None), (7, "w", ""), (8, "x", other), (9, "y", "z" * 400000), (10, "new\r\nline", big), (10, "again", big), (None, "n", big), (None, "o", other)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").repartition(3)
    manifest = warc_zstd.write_pages(pages, str(tmp_path / "warc"))
    got = sorted((str(r["page_id"]), r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc_zstd.read_pages(manifest).collect())
    last = {big: 10, other: 8}
    want = []
    for page, _, html in data:
        raw = (html or "").encode()
        first = last.get(html)
        revisit = first is not None and page != first
        want.append((str(page), len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    assert got == sorted(want)
    assert warc_zstd.read_pages(warc_zstd.write_pages(pages.limit(0), str(tmp_path / "none"))).count() == 0


def test_warc_archives_start_with_their_dictionary():
    records = [warc_zstd._record(str(i), None, (f"<p>{i}</p>" * 50).encode(), None) for i in range(40)]
    data = warc_zstd.write_archive(records)
    assert data[:4] == bytes.fromhex("5d2a4d18")
    found = list(warc_zstd.read_archive(data))
    assert [f["X-Page-ID"] for f, _, _ in found] == [str(i) for i in range(40)]
    assert 8 + int.from_bytes(data[4:8], "little") + sum(n for *_, n in found) == len(data)
    with pytest.raises(ValueError):
        list(warc_zstd.read_archive(data[:-4]))


# ---------------------------------------------------------------- 4


def water_filled(sizes):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: 1 + i % 3 for i, s in enumerate(names)}
    target, free, left = {}, set(names), sum(sizes.values())
    while True:
        share = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * share > 3 * sizes[s]}
        if not over:
            return target | {s: weight[s] * share for s in free}
        for s in over:
            target[s] = 3 * sizes[s]
            left -= 3 * sizes[s]
        free -= over


def test_mixing_targets_and_copies(spark):
    draw = random.Random(5)
    data = [(i, "x " * draw.randrange(1, 60), draw.choice(["src0"] * 40 + ["src1", "src2", "src3", "Ä", None])) for i in range(3000)] + [(5000, None, "src1"), (5001, "", "empty"), (None, "a b", "src2")]
    frame = spark.createDataFrame(data, "doc_id long, text string, source string")
    out = mixing.mix_sources(frame).select("row.*", "size", "source_size", "target", "copies", "taken").collect()
    sizes = Counter()
    for _, text, source in data:
        sizes[source] += len((text or "").split())
    want = water_filled(dict(sizes))
    taken = Counter()
    for r in out:
        assert 0 <= r["copies"] <= 3 and r["taken"] == r["copies"] * r["size"] and r["source_size"] == sizes[r["source"]]
        assert abs(r["target"] - want[r["source"]]) < 1e-6 * max(1, r["target"])
        taken[r["source"]] += r["taken"]
    assert all(abs(taken[s] - want[s]) <= 60 for s in sizes) and abs(sum(want.values()) - sum(sizes.values())) < 1e-6 * sum(sizes.values())
    again = {r["doc_id"]: r["copies"] for r in mixing.mix_sources(frame.repartition(7)).select("row.doc_id", "copies").collect()}
    assert again == {r["doc_id"]: r["copies"] for r in out}


def test_targets_of_very_many_sources(spark):
    draw = random.Random(8)
    sizes = {f"host{i:04d}{draw.choice(['', 'Ä', '😀'])}": int(draw.paretovariate(0.6) * 10) for i in range(4000)} | {None: 77, "empty": 0, "": 0}
    sizes |= {f"like{i}": 500 for i in range(300)}
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")  # so that there are several ranges
    try:
        frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
        ranges = mixing._running(frame, [F.col("source").asc_nulls_last()], ranks=F.lit(1))
        assert sorted(r["ranks_ahead"] for r in ranges.collect()) == list(range(len(sizes)))
        got = {r["source"]: r["target"] for r in mixing.source_targets(frame).collect()}
    finally:
        spark.conf.unset(key)
    want = water_filled(sizes)
    assert set(got) == set(want) and all(abs(got[s] - want[s]) <= 1e-9 * max(1, want[s]) for s in want)


def test_mixing_edges(docs, nothing):
    out = mixing.mix_sources(docs)
    assert out.count() == docs.count() and out.where("copies > 3").count() == 0
    assert mixing.mixed_documents(docs).columns == docs.columns and mixing.mix_sources(nothing).count() == 0


# ---------------------------------------------------------------- 5


def test_alignment_against_a_plain_table():
    draw = np.random.default_rng(3)

    def plain(a, b):
        h = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                h[i, j] = max(0, h[i - 1, j - 1] + (2 if a[i - 1] == b[j - 1] else -1), h[i - 1, j] - 1, h[i, j - 1] - 1)
        return h.max()

    for _ in range(30):
        a = draw.integers(1, 6, draw.integers(1, 12)).astype(np.uint64)
        b = draw.integers(1, 6, (4, draw.integers(1, 15))).astype(np.uint64)
        assert decontamination.align(a, b).tolist() == [plain(a, x) for x in b]


def test_contamination_finds_copies_and_edits(spark, docs, nothing):
    item, short = words(7, 30, 10**6), "two words"
    edited = item.split()
    edited[5], edited[17] = "CHANGED!", "other"
    del edited[24]
    data = [(1, words(8, 50) + " " + item.upper().replace(" ", ", ") + " " + words(9, 50)), (2, " ".join(edited)), (3, words(10, 200)), (4, " ".join(item.split()[:8])), (5, "has two words inside"), (6, None), (7, ""), (1, item)]
    frame = spark.createDataFrame(data, "doc_id long, text string")
    tests = spark.createDataFrame([(0, item), (1, short), (2, None), (3, "")], "item_id long, text string")
    got = sorted((r["doc_id"], r["item_id"], round(r["score"], 1)) for r in decontamination.contaminated(frame, tests).collect())
    assert [(d, i) for d, i, _ in got] == [(1, 0), (1, 0), (2, 0), (5, 1)] and got[0][2] == 1.0 and got[2][2] < 1
    assert sorted(r["doc_id"] for r in decontamination.decontaminated(frame, tests).collect()) == [3, 4, 6, 7]
    assert decontamination.contaminated(nothing, tests).count() == 0 and decontamination.contaminated(docs, tests.limit(0)).count() == 0
    assert decontamination.decontaminated(docs, tests).columns == docs.columns


def test_contamination_against_full_alignment(spark, monkeypatch):
    """Held against aligning every item with every whole document, over several blocks of items."""
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 2000)
    draw = random.Random(23)
    items = [words(f"i{k}", draw.randrange(6, 60), 5000).split() for k in range(40)]
    texts = []
    for k in range(240):
        copy, rate = list(items[k % 40]), draw.choice([0, 0.1, 0.2, 0.3, 0.4])
        for _ in range(int(rate * len(copy))):
            at = draw.randrange(len(copy))
            copy[at : at + draw.randrange(2)] = [f"e{draw.randrange(10**6)}"] * draw.randrange(3)
        texts.append(" ".join([words(f"b{k}", draw.randrange(0, 40), 5000), *copy, words(f"a{k}", draw.randrange(0, 40), 5000)]))
    hashed = lambda t: C.hash_tokens(*C.text_buffers(pa.array([t])), C.NOT_WORDY)[0]
    want = set()
    for d, text in enumerate(texts):
        w = hashed(text)[None, :]
        want |= {(d, i) for i, item in enumerate(items) if decontamination.align(hashed(" ".join(item)), w)[0] >= decontamination.THRESHOLD * decontamination.MATCH * len(item)}
    found = decontamination.contaminated(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), spark.createDataFrame([(i, " ".join(x)) for i, x in enumerate(items)], "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]) for r in found.collect()}
    assert got <= want and len(want) > 100 and len(got) >= 0.97 * len(want)


def test_decontamination_with_clashing_names(spark):
    item = words(7, 30, 10**6)
    frame = spark.createDataFrame([(1, item, 0, "x", 1, 2), (2, "free text", 0, "y", 1, 2)], "_id long, text string, `_hash` int, `_text_hash` string, id int, `my-col` int")
    out = decontamination.decontaminated(frame, spark.createDataFrame([(0, item)], "item_id long, text string"), "_id")
    assert out.columns == frame.columns and [(r["_id"], r["_text_hash"]) for r in out.collect()] == [(2, "y")]


# ---------------------------------------------------------------- 6


def plain_unfiltered(lines, bpp):
    """The row filters undone byte by byte."""
    out = []
    for kind, *row in lines.tolist():
        up, new = out[-1] if out else [0] * len(row), []
        for x, value in enumerate(row):
            a, b, c = (new[x - bpp], up[x], up[x - bpp]) if x >= bpp else (0, up[x], 0)
            p = a + b - c
            nearest = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            new.append((value + (0, a, b, (a + b) // 2, nearest)[kind]) % 256)
        out.append(new)
    return out


def test_pictures_of_several_heights_and_filters_are_undone_together():
    draw = np.random.default_rng(8)
    files, want = [], []
    for height in (1, 40, 3, 7, 1):
        rows = draw.integers(0, 256, (height, 192), dtype=np.uint8)
        kinds = draw.integers(0, 5, height).astype(np.uint8)
        files.append(media_png._file(kinds, rows, 3))
        want.append(plain_unfiltered(np.concatenate([kinds[:, None], rows], axis=1), 3))
    for got, rows in zip(media_png.decode_pngs(files), want):
        assert got.reshape(len(rows), 192).tolist() == rows


def test_texts_are_stored_with_more_than_one_filter(spark):
    texts = [words(k, 400) for k in range(20)] + ["ab" * 5000, " " * 900]
    stored = media_png.store_texts(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    lines = [media_png.opened(r["media"])[0] for r in stored.collect()]
    assert len({k for x in lines for k in x[:, 0].tolist()}) >= 2
    assert all((media_png.decode_png(media_png.encode_png(x)) == x).all() for x in [np.arange(192, dtype=np.uint8).reshape(1, 64, 3)])


def test_cosine_hash_against_sums():
    for shape in ((3, 64, 3), (90, 64, 3)):
        samples = np.random.default_rng(shape[0]).integers(0, 256, shape, dtype=np.uint8)
        grey = samples.astype(float).mean(axis=2)

        def cells(n):
            if n < 32:
                return [[i * n // 32] for i in range(32)]
            return [range(i * n // 32, (i + 1) * n // 32) for i in range(32)]

        small = [[sum(grey[y][x] for y in ys for x in xs) / (len(ys) * len(xs)) for xs in cells(shape[1])] for ys in cells(shape[0])]
        low = [sum(small[y][x] * np.cos(np.pi * u * (2 * y + 1) / 64) * np.cos(np.pi * v * (2 * x + 1) / 64) for y in range(32) for x in range(32)) for u in range(8) for v in range(8)]
        middle = np.median(np.round(low[1:], 6))
        bits = "".join("1" if round(z, 6) > middle else "0" for z in low)
        assert media_png.cosine_hash(samples) == f"{int(bits, 2):016x}"


@pytest.mark.parametrize("kind", [*range(5), None])
@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 64, 3), (7, 5, 4), (2, 9, 2)])
def test_png_round_trip(kind, shape):
    samples = np.random.default_rng(3).integers(0, 256, shape, dtype=np.uint8)
    data = media_png.encode_png(samples, kind)
    assert (media_png.decode_png(data) == samples).all()
    for at in (20, len(data) // 2, len(data) - 6):
        with pytest.raises(ValueError):
            media_png.decode_png(data[:at] + bytes([data[at] ^ 1]) + data[at + 1 :])


def test_media_of_texts(docs, nothing):
    got = media_png.read_features(C.to_table(media_png.store_texts(docs), "media")).collect()
    assert len(got) == docs.count()
    want = []
    for r in docs.collect():
        raw = (r["text"] or "").encode()
        payload = raw + b" " * (max(192, -(-len(raw) // 192) * 192) - len(raw))
        want.append((str(r["doc_id"]), len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:])))
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["payload_bytes"], r["payload_sha256"], r["tail_crc32"]) for r in got) == sorted(want)
    assert len({(r["payload_sha256"], r["media_sha256"], r["feature"]) for r in got}) == len({r["payload_sha256"] for r in got})
    assert media_png.store_texts(nothing).count() == 0


def test_cosine_hash_moves_little_with_noise():
    y, x = np.mgrid[:200, :64]
    picture = np.repeat((127 + 60 * np.sin(x / 9) + 60 * np.cos(y / 31)).astype(np.uint8)[..., None], 3, 2)
    noisy = (picture.astype(int) + np.random.default_rng(1).integers(-3, 4, picture.shape)).clip(0, 255).astype(np.uint8)
    far = lambda a, b: (int(media_png.cosine_hash(a), 16) ^ int(media_png.cosine_hash(b), 16)).bit_count()
    assert far(picture, noisy) < 20 and len(media_png.cosine_hash(picture)) == 16


# ---------------------------------------------------------------- 7


@needs_tables
def test_language_id_on_held_out_text(spark):
    sf = SF.replace("0.001", "0.01")
    got = language_id.identify(C.table(spark, sf, "documents")).join(C.table(spark, sf, "documents").select("doc_id", "lang"), "doc_id")
    assert got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_language_id_edges(docs, nothing):
    got = language_id.identify(docs).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    text = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    for r in got:
        if r["doc_id"] is not None:
            assert (r["lang_pred"] == "und") == (not any(c.isalpha() for c in text[r["doc_id"]] or ""))
            assert r["held_out"] == (part(r["doc_id"], 5) == 0)
    assert {r["lang_pred"] for r in got} <= {"en", "fr", "und"}
    assert language_id.identify(nothing).count() == 0


# ---------------------------------------------------------------- 8


def test_token_counts_agree_with_the_library(spark, docs, nothing):
    public = pytest.importorskip("public_tokenizers")
    import sentencepiece

    path = public.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    odd = ["  a  b\n\n c", " ", "\n", "a\x00b", "日本語 ▁▁x y▁", "😀😀", "x" * 3000, " " * 100, "ab" * 999, "<s>hello</s><0x0A>"]
    frame = docs.select("doc_id", "text").union(spark.createDataFrame([(100 + i, t) for i, t in enumerate(odd)], "doc_id long, text string"))
    got = token_counts.count_tokens(frame, path).collect()
    want = [(str(r["doc_id"]), len((r["text"] or "").encode()), len(library.encode(r["text"] or ""))) for r in frame.collect()]
    assert sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in got) == sorted(want)
    assert all(r["over_limit"] == (r["n_tokens"] > 4096) for r in got)
    assert token_counts.count_tokens(nothing, path).count() == 0


def test_pieces_across_lines_are_refused(tmp_path, monkeypatch):
    public = pytest.importorskip("public_tokenizers")
    path = public.path("piece_bpe_32k.model")
    fields = token_counts._fields
    odd = lambda data: ((n, {1: b"a\nb"}.get(n, v)) if n == 1 and isinstance(v, bytes) and v.startswith("▁the".encode()) else (n, v) for n, v in fields(data))
    monkeypatch.setattr(token_counts, "_fields", odd)
    with pytest.raises(ValueError, match="word boundary"):
        token_counts.load_pieces(path)


# ---------------------------------------------------------------- 9


def test_shards_fit_and_split_only_when_needed(spark, docs, nothing):
    same = "y" * 100
    frame = spark.createDataFrame([(i, words(i, i % 50)) for i in range(2000)] + [(1, same)] * 500 + [(7, "z" * 9000)], "doc_id long, text string").repartition(5)
    limit = 4000
    rows = sharding.assign_shards(frame, limit).select("row.doc_id", F.coalesce(F.octet_length("row.text"), F.lit(0)).alias("size"), "shard", "depth", "page", "bytes").collect()
    assert len(rows) == 2501
    real, count = Counter(), Counter()
    for r in rows:
        real[r["shard"], r["page"]] += r["size"]
        count[r["shard"], r["page"]] += 1
        assert len(r["shard"]) == r["depth"]
    for r in rows:
        key = r["shard"], r["page"]
        assert real[key] == r["bytes"] and (real[key] <= limit or count[key] == 1)
    names = {s for s, _ in real}
    assert not any(a != b and b.startswith(a) for a in names for b in names)
    parents = Counter()
    for (shard, _), n in real.items():
        for k in range(len(shard)):
            parents[shard[:k]] += n
    assert all(n > limit for n in parents.values())
    assert sharding.assign_shards(docs, 1 << 30).where("shard <> '' or depth <> 0").count() == 0
    assert sharding.assign_shards(nothing, limit).count() == 0


# ---------------------------------------------------------------- 10


def brute_components(rows):
    sets = []
    for i, text in rows:
        w = tokens(text)
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a][1] & sets[b][1])
            if sets[a][1] and 100 * both >= 75 * (len(sets[a][1]) + len(sets[b][1]) - both) and sets[b][1]:
                parent[root(a)] = root(b)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[root(x)] = min(i, least.get(root(x), i))
    return sorted((str(i), len(s), str(least.get(root(x)) if s else i)) for x, (i, s) in enumerate(sets))


def test_jaccard_join_against_brute_force(spark, docs, nothing):
    draw, data = random.Random(11), [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    shared = words("shared", 70)
    for group in range(40):
        base = words(f"g{group}", draw.choice([1, 2, 4, 5, 6, 9, 14, 40, 130, 260]), 10**6).split()
        for _ in range(draw.choice([1, 2, 6, 12])):
            copy = list(base)
            for _ in range(draw.randrange(0, 4)):
                copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
            data.append((len(data) + 100, " ".join(copy) + (" " + shared if draw.random() < 0.3 else "")))
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(6)
    got = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in jaccard_join.jaccard_components(frame).collect())
    assert got == brute_components(data)
    kept = jaccard_join.one_of_each(frame)
    with_text = sum(1 for i, n, c in got if n and i == c)
    assert kept.columns == ["doc_id", "text"] and kept.where("length(trim(text)) > 3").count() <= with_text
    assert jaccard_join.jaccard_components(nothing).count() == 0


@pytest.mark.parametrize("edits", [(2, 3), (0, 2)])  # copies near the limit, and one main component
def test_jaccard_join_of_a_large_group_in_blocks(spark, monkeypatch, edits):
    monkeypatch.setattr(jaccard_join, "BLOCK_WEIGHT", 40 * (jaccard_join.SET_WEIGHT + 96))
    if edits[0] == 0:  # with most values as single rows
        monkeypatch.setattr(jaccard_join, "HOT", 16)
    draw, base, data = random.Random(17), words("group", 100, 10**6).split(), []
    for k in range(400):
        copy = list(base)
        for _ in range(draw.randint(*edits)):
            copy[draw.randrange(len(copy))] = f"e{draw.randrange(10**6)}"
        data.append((k, " ".join(copy)))
    data += [(1000 + k, " ".join(base[:60]) + " " + words(k, 35 + k % 9, 10**6)) for k in range(60)]
    got = jaccard_join.jaccard_components(spark.createDataFrame(data, "doc_id long, text string").repartition(5))
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got.collect()) == brute_components(data)


def test_one_of_each_with_clashing_names(spark):
    text = words(3, 30)
    frame = spark.createDataFrame([(1, text, 7, "x", 8, 9), (2, text, 7, "y", 8, 9), (3, None, 7, "z", 8, 9)], "_id long, text string, `_hash` int, `_text_hash` string, id int, `my-col` int")
    out = jaccard_join.one_of_each(frame, id_col="_id")
    assert out.columns == frame.columns and sorted((r["_id"], r["_text_hash"]) for r in out.collect()) == [(1, "x"), (3, "z")]


def test_merging_labels_after_further_links(spark):
    pairs = lambda x: spark.createDataFrame(x, "a long, b long")
    labels = components.components(pairs([(1, 2), (3, 4), (5, 6), (8, 9)]))
    got = {r["node"]: r["label"] for r in components.merged(labels, pairs([(4, 5), (7, 8)])).collect()}
    assert got == {1: 1, 2: 1, 3: 3, 4: 3, 5: 3, 6: 3, 7: 7, 8: 7, 9: 7}


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7)]
    got = {r["node"]: r["label"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 140)}


# ---------------------------------------------------------------- queries and pipeline


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_agree_with_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.queries()[name](spark, SF)
    columns = sorted(got.columns)
    want = con.sql(f"SELECT {', '.join(columns)} FROM ({queries.oracle_sql()[name]})").fetchall()
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)) for r in got.select(*columns).collect())


def test_pipeline_against_brute_force(spark, tmp_path, monkeypatch):
    """run() on a small corpus: copies, a large group of near copies, benchmark passages, odd rows."""
    import corpus_pipeline

    draw, item = random.Random(29), words("item", 40, 10**6)
    texts = [words(f"t{k}", draw.randrange(20, 120), 10**6) for k in range(120)]
    base = words("base", 90, 10**6).split()
    for k in range(300):
        copy = list(base)
        for _ in range(draw.randrange(4)):
            copy[draw.randrange(90)] = f"e{draw.randrange(10**6)}"
        texts.append(" ".join(copy))
    texts += texts[:15] + [words(f"l{k}", 30, 10**6) + " " + item.upper() for k in range(6)] + ["junk ||| " * 30] * 3 + [None, "", " \n"]
    data = [(k, t, "en", f"s{k % 4}", len(t or ""), "own") for k, t in enumerate(texts)] + [(3, texts[3], "en", "s3", 5, "own"), (None, words("nobody", 40, 10**6), None, None, None, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long, `bytes` string")
    labels = spark.createDataFrame([(k, int("junk" not in (t or "")), 0) for k, t in enumerate(texts) if k % 3 == 0 or "junk" in (t or "")], "doc_id long, quality int, toxic int")
    for name, table in (("documents", docs), ("labels", labels), ("benchmark", spark.createDataFrame([(0, item)], "item_id long, text string"))):
        table.write.parquet(str(tmp_path / f"{name}.parquet"))
    decide = quality.good_documents
    judged = []
    monkeypatch.setattr(quality, "good_documents", lambda *a: judged.append(C.to_table(decide(*a), "judged")) or judged[0])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert out[0].asDict().keys() == {*docs.columns, "shard", "depth", "page", "_bytes"}
    kept = [(r["doc_id"], r["text"], r["source"]) for r in judged[0].collect()]
    assert sum("nobody" not in str(x[1]) for x in kept) > 400
    # one of each class, the least (id, nulls last); rows without words stay
    worded = sorted({x for x in kept if tokens(x[1])}, key=lambda x: (x[0] is None, x[0] or 0))
    classes = brute_classes([x[1] for x in worded])
    least = {}
    for c, x in zip(classes, worded):
        least.setdefault(c, x)
    clean = [x for x in least.values() if item.upper() not in x[1]] + [x for x in kept if not tokens(x[1])]
    mixed = Counter((r["doc_id"], r["text"], r["source"]) for r in out)
    assert set(mixed) <= set(clean) and max(mixed.values()) <= 3
    assert all(mixed[x] == 1 for x in clean if not tokens(x[1]))
    sizes = Counter()
    for x in clean:
        sizes[x[2]] += len(tokens(x[1]))
    want, taken = water_filled(dict(sizes)), Counter()
    for x, n in mixed.items():
        taken[x[2]] += n * len(tokens(x[1]))
    assert all(abs(taken[s] - want[s]) <= 130 for s in sizes)
    real = Counter()
    for r in out:
        real[r["shard"], r["page"]] += len((r["text"] or "").encode())
    assert all(real[r["shard"], r["page"]] == r["_bytes"] <= corpus_pipeline.SHARD_BYTES for r in out)


def brute_classes(texts):
    """A class for each text, by comparing all of them."""
    sets = []
    for text in texts:
        w = tokens(text)
        sets.append(frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both):
                parent[root(a)] = root(b)
    return [root(x) for x in range(len(sets))]


@needs_tables
def test_pipeline_runs_and_each_stage_takes_effect(spark):
    import corpus_pipeline

    frame = C.table(spark, SF, "documents")
    columns, counts = frame.columns, [frame.count()]
    for _, stage in corpus_pipeline.STAGES:
        frame = C.to_table(stage(spark, frame, SF), "stage")
        counts.append(frame.count())
    assert counts[0] > counts[1] > counts[2] >= counts[3] and counts[4] == counts[5]
    assert frame.columns == [*columns, "shard", "depth", "page", "bytes"]


def test_token_hashes_match_python():
    texts = ["The cat  THE\tCAT", "", None, " x", "é É\x0bab", "a-b c"]
    data, offsets = C.text_buffers(pa.array(texts))
    h, n = C.hash_tokens(data, offsets)
    flat = [w for t in texts for w in tokens(t)]
    assert n.tolist() == [len(tokens(t)) for t in texts] and len(set(zip(h.tolist(), flat))) == len(set(flat)) == len(set(h.tolist()))
