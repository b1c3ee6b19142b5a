"""Operators on texts against plain versions, with null, empty, repeated, tied and very long inputs."""

import hashlib
import os
import random
import zlib
from collections import Counter, defaultdict

import brute
import pytest
from compare import connect, differences
from conftest import TESTDATA
from pyspark.sql import functions as F

from footlight.llm import languages, minhash, mixing, pieces, queries, recompression, sharding, syncmers

SMALL = f"{TESTDATA}/sf0.001"
# Other columns of a table may have the names that operators use inside.
CLASH = ["id", "tk", "n", "rep", "size", "key", "bucket", "rest", "mark", "name", "shard", "order", "position", "ids", "h", "kept"]


def sample_texts(seed: int = 5) -> list[str | None]:
    r = random.Random(seed)
    vocab = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(400)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    passage, texts = prose(60), [None, "", "  \n\t ", "one", "Two words", "one", "☃ \U0001f600 x"]
    for _ in range(25):
        texts.append(prose(r.randint(3, 200)))
    base = prose(150).split(" ")
    for i in range(30):  # a chain and a crowd of near copies
        copy = list(base)
        for _ in range(i % 9):
            copy[r.randrange(len(copy))] = r.choice(vocab)
        texts.append(" ".join(copy).title() if i % 7 == 0 else "\n".join(copy))
    for _ in range(6):
        texts.append(f"{prose(r.randint(0, 40))} {passage}\t{prose(r.randint(0, 40))}")
    texts += ["same words " * 40, "same words " * 25, "x " * 300, "x " * 36, prose(34), "Exact copy of a text " * 9, "Exact copy of a text " * 9]
    texts.append(prose(40_000) + " " + passage)
    return texts


def frame(spark, rows, schema="doc_id long, text string"):
    out = spark.createDataFrame(rows, schema).repartition(3)
    return out.withColumns({c: F.lit("?") for c in CLASH})


@pytest.fixture(scope="module")
def texts():
    return sample_texts()


@pytest.fixture(scope="module")
def docs(spark, texts):
    return frame(spark, [(7 * i + 3, t) for i, t in enumerate(texts)])


@pytest.mark.parametrize("words, share, bands, rows", [(3, (85, 100), 26, 6), (5, (80, 100), 32, 5)])
def test_near_duplicates(docs, texts, words, share, bands, rows):
    got = minhash.near_duplicates(docs, words=words, share=share, bands=bands, rows=rows).collect()
    expected = brute.near_duplicates({7 * i + 3: t for i, t in enumerate(texts)}, words, share)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    assert len({c for _, c in expected.values()}) < len(texts) - 12


def test_near_duplicates_in_small_tiles(docs, texts, monkeypatch):
    monkeypatch.setattr(minhash, "TILE", 4)
    got = minhash.near_duplicates(docs, words=3, share=(85, 100), bands=26, rows=6).collect()
    expected = brute.near_duplicates({7 * i + 3: t for i, t in enumerate(texts)}, 3, (85, 100))
    assert {r["doc_id"]: r["component_id"] for r in got} == {i: c for i, (_, c) in expected.items()}


def test_near_duplicates_repeated_and_missing_ids(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (5, "A b c d e f"), (6, None), (7, " ")]
    got = minhash.near_duplicates(frame(spark, rows)).collect()
    found = Counter((r["doc_id"], r["component_id"], r["kept"]) for r in got)
    assert found == Counter({(1, 1, True): 2, (None, None, True): 1, (5, 1, False): 1, (6, 6, True): 1, (7, 7, True): 1})
    assert minhash.near_duplicates(frame(spark, [])).count() == 0


@pytest.mark.parametrize("window", [35, 5])
@pytest.mark.parametrize("rounds", [3, 5])
def test_repeats_are_removed(docs, texts, window, rounds):
    got = {r["doc_id"]: r for r in recompression.remove_repeats(docs, window=window, rounds=rounds, keep=["rest", "tk"]).collect()}
    for i, (n, removed, kept) in enumerate(brute.without_repeats(texts, window)):
        r = got[7 * i + 3]
        assert (r["n_words"], r["n_removed"], brute.words(r["kept"])) == (n, removed, kept)
        assert (r["kept"] is None) == (texts[i] is None) and r["rest"] == r["tk"] == "?"
        if not removed:
            assert r["kept"] == texts[i]


def test_repeats_in_repeated_rows_and_empty_tables(spark):
    long = " ".join(f"w{i}" for i in range(40))
    rows = [(1, long), (1, long), (None, long + " end"), (2, "short"), (3, None)]
    got = recompression.remove_repeats(frame(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_removed"], r["kept"]) for r in got) == Counter(
        {(1, 40, ""): 2, (None, 40, "end"): 1, (2, 0, "short"): 1, (3, 0, None): 1}
    )
    assert recompression.remove_repeats(frame(spark, [])).count() == 0
    with pytest.raises(ValueError):
        recompression.remove_repeats(frame(spark, []), window=1)


def test_recompression_is_local(spark):
    """Equal stretches have equal symbols inside, whatever surrounds them."""
    import numpy as np

    r = np.random.default_rng(1)
    inner = r.integers(0, 50, 60).astype(np.uint64)
    seen = []
    for pre in (3, 11):
        h = np.concatenate([r.integers(0, 50, pre).astype(np.uint64), inner, r.integers(0, 50, 7).astype(np.uint64)])
        name, low, high = recompression.recompress(h, np.zeros(len(h), np.int64), 3)
        inside = (low >= pre) & (high <= pre + len(inner))
        seen.append(list(zip(name[inside].tolist(), (low[inside] - pre).tolist(), (high[inside] - pre).tolist())))
    assert seen[0] == seen[1] and len(seen[0]) > 5


def test_pieces_equal_the_library(spark, docs, texts):
    import sentencepiece

    more = ["Hello  world\n\tfoo   ", " a", "x▁y ▁▁z", "日本語 é́", " " * 45 + "x" + " " * 20, "<s> <0x41> </s>", "a" * 5000]
    table = frame(spark, [(i, t) for i, t in enumerate([*texts, *more])])
    library = sentencepiece.SentencePieceProcessor(model_file=pieces.MODEL)
    coded = pieces.encode(table, ["doc_id", "id"])
    got = {r["doc_id"]: r["ids"] for r in coded.collect()}
    assert got == {i: None if t is None else library.encode(t) for i, t in enumerate([*texts, *more])}
    back = {r["doc_id"]: r["text"] for r in pieces.decode(coded, ["doc_id"]).collect()}
    assert back == {i: None if t is None else t.replace("▁", " ") for i, t in enumerate([*texts, *more])}
    assert pieces.encode(frame(spark, []), ["doc_id"]).count() == 0


def test_pieces_of_a_unigram_model(spark, texts, tmp_path):
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as formats

    proto = formats.ModelProto()
    with open(pieces.MODEL, "rb") as f:
        proto.ParseFromString(f.read())
    proto.trainer_spec.model_type = 1
    r = random.Random(3)
    for p in proto.pieces:
        if p.type == 1:
            p.score = -r.uniform(5, 15)
    path = str(tmp_path / "unigram.model")
    with open(path, "wb") as f:
        f.write(proto.SerializeToString())
    some = [t for t in texts if t][:40]
    coded = pieces.encode(frame(spark, list(enumerate(some))), ["doc_id"], model=pieces.load_model(path))
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    got = {r["doc_id"]: r["ids"] for r in coded.collect()}
    total = lambda ids: sum(proto.pieces[i].score for i in ids)
    for i, t in enumerate(some):  # pieces of equal score may stand in either order
        other = library.encode(t)
        assert abs(total(got[i]) - total(other)) < 1e-3 and sorted(got[i]) == sorted(other)


def test_decoding_ids_that_are_no_text(spark):
    rows = spark.createDataFrame([(1, [3 + 0xE2]), (2, []), (3, None), (4, [1, 3 + 0x41, 2, 0])], "doc_id long, ids array<int>")
    got = {r["doc_id"]: r["text"] for r in pieces.decode(rows, ["doc_id"]).collect()}
    assert got == {1: "�", 2: "", 3: None, 4: "A ⁇ "}


def test_languages_of_held_out_documents(spark):
    out = queries.QUERIES["op8_language_id"](spark, f"{TESTDATA}/sf0.01")
    truth = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = out.join(truth, "doc_id").where("held_out").collect()
    assert len(rows) > 200 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.98 * len(rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in rows)


def test_language_mixtures_and_edge_cases(spark):
    en = ["the cat sat on the mat with that thing", "this is what they think of the weather", "which of these would you rather have"] * 5
    de = ["der hund ging durch die straße und schlief", "wir haben das nicht gewusst und gehen nach hause", "ein schönes haus"] * 5
    rows = [(i, t, "en") for i, t in enumerate(en)] + [(100 + i, t, "de") for i, t in enumerate(de)] + [(900, None, "en"), (901, "x", None)]
    labelled = frame(spark, rows, "doc_id long, text string, lang string")
    model = languages.fit(labelled, "doc_id", "text", "lang")
    assert model[0] == ["de", "en"]
    asked = [(1, None), (2, ""), (3, "12 !? 34"), (4, en[0]), (5, de[0]), (6, " ".join((en + de) * 3)), (None, "ß"), (8, en[1] * 5000), (8, de[1])]
    got = defaultdict(list)
    for r in languages.identify(frame(spark, asked), model, ["doc_id", "id"]).collect():
        got[r["doc_id"]].append((r["lang_pred"], r["score"], sorted(r["languages"]), sum(r["shares"])))
    assert [got[i][0][:2] for i in (1, 2, 3)] == [("und", 0.0)] * 3
    assert got[4][0][0] == "en" and got[5][0][0] == "de" and len(got[8]) == 2 and got[None][0][0] in ("de", "en")
    assert got[6][0][2] == ["de", "en"] and 0.5 <= got[6][0][1] < 0.8 and abs(got[6][0][3] - 1) < 1e-6
    nothing = languages.fit(labelled.limit(0), "doc_id", "text", "lang")
    assert {r["lang_pred"] for r in languages.identify(frame(spark, asked), nothing, ["doc_id"]).collect()} == {"und"}
    assert languages.identify(frame(spark, []), model, ["doc_id"]).count() == 0


def test_mixing_reaches_its_targets(spark):
    r = random.Random(2)
    rows = [(i, " ".join("w" * r.randint(1, 3) for _ in range(r.randint(0, 90))), r.choice(["a", "b", "B", None, "é"])) for i in range(400)]
    rows += [(1000 + i, "hot words here", "hot") for i in range(300)] + [(5000, None, "none"), (5001, "z " * 9000, "b"), (7, "same id", "a"), (7, "same id", "a"), (None, "no id", "a")]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    got = mixing.mix(docs, queries._SCHEDULES).collect()
    assert len(got) == len(rows)
    size, taken, target = Counter(), Counter(), {}
    for x in got:
        size[x["source"]] += x["size"]
        taken[x["source"]] += x["taken"]
        target[x["source"]] = x["target"]
        assert 0 <= x["taken"] <= 2 * x["size"] and x["taken"] == sum(p["words"] for p in x["passes"])
        assert all(0 <= p["position"] <= 1 for p in x["passes"])
    order = sorted((s for s in size if s is not None)) + [None]
    weight = {s: [3.0, 1.0, 2.0][i % 3] for i, s in enumerate(order)}
    want, left, share = 1.5 * sum(size.values()), set(order), {}
    while left:  # deal by weight, fill, deal again
        each = want / sum(weight[s] for s in left)
        full = {s for s in left if each * weight[s] > 2 * size[s]}
        share |= {s: 2.0 * size[s] for s in full} or {s: each * weight[s] for s in left}
        left = left - full if full else set()
        want -= sum(2 * size[s] for s in full)
    assert all(abs(target[s] - share[s]) < 1e-6 and abs(taken[s] - share[s]) <= 1 for s in order)
    assert sorted(map(str, got)) == sorted(map(str, mixing.mix(docs.repartition(5), queries._SCHEDULES).collect()))
    assert mixing.mix(frame(spark, [], "doc_id long, text string, source string"), queries._SCHEDULES).count() == 0
    blank = mixing.mix(frame(spark, [(1, "", "a"), (2, None, None)], "doc_id long, text string, source string"), queries._SCHEDULES)
    assert {(x["taken"], x["target"]) for x in blank.collect()} == {(0, 0.0)}


def test_positions_follow_the_schedules(spark):
    """Half way through, a source has given the integral of its schedule up to there."""
    rows = [(i, "w " * 10, s) for i, s in enumerate(["a", "b"] * 1000)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    falling, rising = [(0.0, 2.0), (1.0, 0.0)], [(0.0, 0.0), (0.5, 0.5), (1.0, 1.5)]
    order = mixing.training_order(mixing.mix(docs, [falling, rising], share=(1, 1))).join(docs.select("doc_id", "source"), "doc_id").collect()
    done = defaultdict(float)
    for x in order:
        done[x["source"], x["position"] < 0.5] += x["words"]
    assert abs(done["a", True] / (done["a", True] + done["a", False]) - 0.75) < 0.01
    assert abs(done["b", True] / (done["b", True] + done["b", False]) - 0.125 / 0.625) < 0.01
    with pytest.raises(ValueError):
        mixing.mix(docs, [[(0.0, 1.0), (0.9, 1.0)]])


def test_shards_match_sql(spark):
    con = connect(SMALL)
    out = queries.QUERIES["op3_sharding"](spark, SMALL)
    assert set(out.columns) == {"doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"}
    assert differences(out.select("doc_id", "size", "shard", "slot"), con, queries.SHARD_SQL) == []


@pytest.mark.parametrize("ranges", [None, 40])
def test_shards_are_even(spark, texts, ranges):
    hot = [(i, "a heavy text that is met very often") for i in range(1000, 2000)]
    rows = [(i, t) for i, t in enumerate(texts) if len(t or "") < 5000] + hot + [(3, None), (3, None), (None, "x")]
    got = sharding.assign_shards(frame(spark, rows), 4, ranges=ranges).collect()
    assert len(got) == len(rows)
    crc = {t: None if t is None else zlib.crc32(t.encode()) for _, t in rows}
    assert Counter(x["text_crc32"] for x in got) == Counter(crc[t] for _, t in rows)
    slots, size = defaultdict(list), Counter()
    for x in got:
        slots[x["shard"]].append(x["slot"])
        size[x["shard"]] += x["size"]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and set(slots) == {0, 1, 2, 3}
    assert max(size.values()) - min(size.values()) < 1200
    assert sharding.assign_shards(frame(spark, []), 4).count() == 0


def test_written_shards(spark, tmp_path):
    docs = spark.createDataFrame([(i, f"text {i}" * (i % 5)) for i in range(60)], "doc_id long, text string")
    assigned = sharding.assign_shards(docs, 3)
    sharding.write_shards(docs, assigned, str(tmp_path / "out"))
    read = spark.read.parquet(str(tmp_path / "out"))
    assert read.select("doc_id", "shard", "slot").exceptAll(assigned.select("doc_id", "shard", "slot")).count() == 0
    assert read.count() == 60 and len([d for d in os.listdir(tmp_path / "out") if d.startswith("shard=")]) == 3


def test_fingerprints(spark, texts):
    rows = [(7 * i + 3, t) for i, t in enumerate(texts) if len(t or "") < 20_000]
    got = syncmers.compare_neighbours(frame(spark, rows)).collect()
    expected = brute.neighbours(rows)
    assert len(got) == len(rows)
    for x in got:
        assert tuple(x)[1:] == expected[x["doc_id"]]
    alike = defaultdict(set)
    for x in got:
        alike[dict(rows)[x["doc_id"]]].add(x["fingerprint"])
    assert all(len(v) == 1 for v in alike.values())


def test_fingerprints_of_odd_tables(spark):
    one = syncmers.compare_neighbours(frame(spark, [(1, "abcd")])).first()
    assert (one["n_chars"], one["near_edited"], one["near_next"]) == (4, 0.0, 1.0)
    rows = [(None, "null id"), (4, "twice"), (4, "twice"), (9, None)]
    got = Counter((x["doc_id"], x["n_chars"]) for x in syncmers.compare_neighbours(frame(spark, rows)).collect())
    assert got == Counter({(None, 7): 1, (4, 5): 2, (9, 0): 1})
    assert syncmers.compare_neighbours(frame(spark, [])).count() == 0


def test_fingerprints_of_few_words_and_no_blanks(spark):
    """Texts of all lengths have one kind of anchor, and likeness is that of the fingerprints shown."""
    r = random.Random(11)
    word = lambda a: "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(r.randint(a, 8)))
    prose = [" ".join(word(5) for _ in range(n)) for n in [*range(10, 31), *range(10, 31), 60, 63, 64, 70, 300, 900]]
    solid = ["".join(chr(r.randrange(0x4E00, 0x9FA5)) for _ in range(n)) for n in (72, 200, 5000)] + ["\U0001f600\u6f22" * 40]
    texts = prose + solid + ["".join(r.choice("xyz") for _ in range(2000)) + " a" * 100, None, "", " ", "one", "two words"]
    r.shuffle(texts)
    rows = list(enumerate(texts))
    got = {x["doc_id"]: x for x in syncmers.compare_neighbours(frame(spark, rows)).collect()}
    assert len(got) == len(rows)

    def like(a, b):
        x, y = ({p.split(":")[1] for p in f.split(" ") if p} for f in (a, b))
        return 1.0 if not x and not y else len(x & y) / max(len(x), len(y))

    for i, text in rows:
        x = got[i]
        plain = " ".join(f"{p}:{h % (1 << 64):X}" for p, h in brute.anchors(text))
        assert x["fingerprint"] == plain and (plain == "") == (not (text or "").strip())
        assert x["near_edited"] == like(x["fingerprint"], x["edited_fingerprint"])
        assert x["near_next"] == like(x["fingerprint"], got[(i - 1) % len(rows)]["fingerprint"])
        if len(text or "") > 60 and len(texts[(i - 1) % len(texts)] or "") > 9:
            assert x["near_edited"] > x["near_next"]


def test_fingerprints_without_ids(spark):
    """Rows without an id follow the others by a hash of their text, in many buckets."""
    rows = [(None, f"some text number {i} of a few words {i * i}") for i in range(300)] + [(5, "with id"), (9, "with id too")]
    got = syncmers.compare_neighbours(frame(spark, rows)).collect()
    assert len(got) == 302
    placed = syncmers.with_next(frame(spark, rows), "doc_id", "text").where("not _next_row").groupBy("bucket").count().collect()
    assert len(placed) > 200 and max(r["count"] for r in placed) < 10
    key = lambda t: brute._xx(t)
    order = [(9, "with id too"), (5, "with id"), *sorted(rows[:300], key=lambda r: -key(r[1]))]
    edited = Counter()
    for i, (_, t) in enumerate(order):
        other, half = order[(i + 1) % len(order)][1], len(t) // 2
        edited[hashlib.sha256((t[: len(t) - half] + other[:half]).encode()).hexdigest()] += 1
    assert Counter(x["edited_sha256"] for x in got) == edited


def test_shards_hold_every_row(spark):
    """Rows without an id, of one heavy text and of others, all get a shard and a slot."""
    rows = [(None, "heavy " * 30)] * 400 + [(i, f"text {i}") for i in range(60)] + [(7, "heavy " * 30)] * 5 + [(None, None)] * 9
    got = sharding.assign_shards(frame(spark, rows), 16).collect()
    assert len(got) == len(rows) and Counter((r["doc_id"], r["size"]) for r in got) == Counter((i, len(t or "") + 1) for i, t in rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(v) == list(range(len(v))) for v in slots.values()) and set(slots) <= set(range(16))
    sizes = Counter()
    for r in got:
        sizes[r["shard"]] += r["size"]
    assert max(sizes.values()) - min(sizes.values()) < 2 * 181 + 20
    assert sharding.assign_shards(frame(spark, [(None, "same")] * 100 + [(i, "x") for i in range(9)]), 16).count() == 109


def test_anchors_need_no_context():
    r = random.Random(8)
    shared = " ".join(f"w{r.randrange(300)}" for _ in range(60))
    sides = [" ".join(f"v{r.randrange(300)}" for _ in range(20)) for _ in range(4)]
    a, b = ({h for _, h in brute.anchors(f"{sides[i]} {shared} {sides[i + 1]}")} for i in (0, 2))
    assert {h for _, h in brute.anchors(shared)} <= a & b


