"""Decontamination, prefix trie and structure repair against plain versions, with nulls, ties, repeats, long and empty inputs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict
from functools import cache

import pytest
from compare import connect, differences
from conftest import TESTDATA
from pyspark.sql import functions as F

from footlight.llm import leaks, queries, repair, trie

SMALL = f"{TESTDATA}/sf0.001"
CLASH = ["rest", "runs", "items", "n_words", "n_hit", "id", "present", "same", "n", "m", "a", "depth", "owner", "conv", "len"]


def frame(spark, rows, schema):
    out = spark.createDataFrame(rows, schema).repartition(3)
    return out.withColumns({c: F.lit("?") for c in CLASH if c not in out.columns})


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Decontamination --------------------------------------------------------------


def plain_words(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [w for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower) if w]


def plain_leaks(text, items, window):
    """(words, hit words, items) by comparing every window with every item's."""
    w, hit, found = plain_words(text), set(), set()
    for item, own in items:
        own = plain_words(own)
        n = min(len(own), window)
        for i in range(len(own) - n + 1) if n else ():
            for j in range(len(w) - n + 1):
                if w[j : j + n] == own[i : i + n]:
                    hit.update(range(j, j + n))
                    found.add(item)
    return len(w), len(hit), sorted(str(i) for i in found if i is not None)


def leak_inputs():
    r = random.Random(3)
    vocab = ["".join(r.choice("abcé9") for _ in range(r.randint(1, 12))) for _ in range(60)]
    prose = lambda n: " ".join(r.choice(vocab) for _ in range(n))
    long = prose(500)
    items = [(1, prose(25)), (2, prose(10)), (10, "Short ITEM, three"), (11, ""), (12, None), (13, "..."), (None, prose(14)), (1, prose(12)), (7, long), (8, "one")]
    items += [(20 + i, items[0][1] + " " + prose(4)) for i in range(5)]  # items that share windows
    texts = [None, "", " .,;", "one", "a short item  THREE b", "short item"]
    for _, text in items:
        w = (text or "").split(" ")
        texts += [f"{prose(8)} {text} {prose(8)}", prose(5) + "\n" + "--".join(w).upper().replace("É", "é"), " ".join(w[: len(w) // 2]), " ".join(w[3:-3])]
    texts += [items[0][1] + ". " + items[0][1], " ".join(long.split(" ")[250:280]), prose(1500) + " " + items[1][1] + " " + prose(1500)]
    return [(i, t) for i, t in enumerate(texts)] + [(3, "one"), (None, "one"), (None, None)], items


@pytest.mark.parametrize("parts", [False, True])
def test_leaks(spark, monkeypatch, parts):
    if parts:  # the benchmark in several parts, its long item in many chunks, and items listed a few at a time
        monkeypatch.setattr(leaks, "PART_BYTES", 5000)
        monkeypatch.setattr(leaks, "CHUNK", 64)
        monkeypatch.setattr(leaks, "LISTED", 4)
    rows, items = leak_inputs()
    docs, tests = frame(spark, rows, "doc_id long, text string"), frame(spark, items, "item_id long, text string")
    found = leaks.find_leaks(docs, tests, ["doc_id", "n_hit"]).collect()
    got = Counter((r["rest"]["doc_id"], r["rest"]["n_hit"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in found)
    plain = {t: plain_leaks(t, items, 10) for t in {t for _, t in rows}}
    assert got == Counter((i, "?", n, h, tuple(x)) for i, t in rows for n, h, x in [plain[t]])
    assert sum(h > 0 for _, h, _ in plain.values()) > 20 and any(len(x) > 5 for *_, x in plain.values())

    cut = leaks.decontaminate(docs, tests)
    assert cut.columns == docs.columns and cut.where(F.col("items") != "?").count() == 0
    left = Counter((r["doc_id"], r["text"] if not plain_leaks(r["text"], items, 10)[1] else None, len(plain_words(r["text"]))) for r in cut.collect())
    assert sum(left.values()) == len(rows)
    assert Counter((i, n) for i, _, n in left.elements()) == Counter((i, plain[t][0] - plain[t][1]) for i, t in rows)
    clean = Counter((i, t) for i, t in rows if not plain[t][1])
    assert clean <= Counter((i, t) for i, t, _ in left.elements())
    stay = leaks.decontaminate(docs, tests, drop_documents=True).collect()
    assert Counter((r["doc_id"], r["text"]) for r in stay) == Counter((i, t) for i, t in rows if not plain[t][1])


def test_leaks_cut_bytes(spark):
    docs = spark.createDataFrame([(1, "É keep, One two! keep é"), (2, "one two"), (3, None)], "doc_id long, text string")
    tests = spark.createDataFrame([(5, "one TWO")], "item_id long, text string")
    assert {r["doc_id"]: r["text"] for r in leaks.decontaminate(docs, tests).collect()} == {1: "É keep, ! keep é", 2: "", 3: None}
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert leaks.find_leaks(docs, nothing, ["doc_id"]).agg(F.sum("n_words"), F.sum("n_hit")).first() == (8, 0)
    assert leaks.find_leaks(docs.limit(0), tests, ["doc_id"]).count() == 0
    with pytest.raises(ValueError):
        leaks.find_leaks(docs, tests, [], window=0)


def test_leaks_of_clashing_hashes(spark, monkeypatch):
    """Two windows with one hash raise the seed; a document window with a test window's hash is compared by its words."""
    real = leaks.textops.hash_spans
    monkeypatch.setattr(leaks.textops, "hash_spans", lambda d, s, e, seed=0: real(d, s, e, seed) & (leaks.np.uint64(0) if seed < 2 else leaks.np.uint64(2**64 - 1)))
    import pyarrow as pa

    part = leaks.build_part(pa.array(["1", "2", "3"]), pa.array(["a b c", "d e f", "g h i"]), 3)
    assert part.seed >= 2 and len(part.windows[0].hashes) == 3


def test_op11_query(spark):
    got = queries.op11_benchmark_decontamination(spark, SMALL)
    assert differences(got, connect(SMALL), queries.ORACLES["op11_benchmark_decontamination"]) == []
    assert got.where("contaminated").count() > 0


# Prefix trie ------------------------------------------------------------------


def plain_trie(rows, base, head):
    """Every node from the rebuilt sequences themselves."""
    own = defaultdict(list)
    order = lambda r: (r[1] is not None, r[1] or 0, hashlib.md5(f"{len(r[2] or '')}:{r[2] or ''}{r[3] or ''}".encode()).hexdigest())
    for r in sorted((r for r in rows if r[0] is not None), key=order):
        own[r[0]].append((r[2] or "", r[3] or ""))
    built = {c: tuple(own.get(base(c), [])[: head(c)] + turns[head(c) :]) for c, turns in own.items()}
    nodes = defaultdict(list)
    for c in sorted(built):
        for d in range(len(built[c]) + 1):
            nodes[built[c][:d]].append(c)
    kids = Counter(k[:-1] for k in nodes if k)
    out = {}
    for k, members in nodes.items():
        below = [o for o in nodes if o[: len(k)] == k]
        saved = sum((len(nodes[o]) - 1) * len(o[-1][1]) for o in below if o)
        ends = ",".join(str(c) for c in members if built[c] == k)
        out[members[0], len(k)] = (nodes[k[:-1]][0] if k else None, len(members), kids[k], sum(not kids[o] for o in below), saved, sha(ends))
    return out


def got_trie(df):
    names = ("parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    rows = [((r["conv_id"], r["depth"]), tuple(r[c] for c in names)) for r in df.collect()]
    assert len(dict(rows)) == len(rows)
    return dict(rows)


def checksum(c):
    return zlib.crc32(str(c).encode()) % 6


def spark_head(c):
    return F.crc32(c.cast("string").cast("binary")) % 6


TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed, convs=160):
    r = random.Random(seed)
    says = ["", "a", "bb", "ccc é", None]
    rows = []
    for _ in range(convs):
        c = r.choice([r.randint(-205, 320), r.randint(0, 12), 100 * r.randint(0, 3)])
        rows += [(c, t if r.random() < 0.9 else None, r.choice(["user", "user", "assistant", None]), r.choice(says)) for t in range(r.randint(1, 6))]
    long = [(400, t, "user", "xy" if t % 3 else "z") for t in range(150)]
    rows += long + [(407, *x[1:]) for x in long] + [(408, *x[1:]) for x in long[:120]] + [(409, *x[1:]) for x in long[:120]]
    return rows + rows[:9] + [(None, 1, "user", "lost")]


@pytest.mark.parametrize("seed", [1, 2])
def test_trie(spark, monkeypatch, seed):
    monkeypatch.setattr(trie, "LEVELS", 7)
    monkeypatch.setattr(trie, "CHUNK", 3)
    rows = conversations(seed)
    df = frame(spark, rows, TURNS)
    got = got_trie(trie.prefix_trie(df, lambda c: c - c % 100, spark_head, 5))
    # The remainder has the sign of the id, as in SQL.
    base = lambda c: c - (abs(c) % 100) * (1 if c >= 0 else -1)
    assert got == plain_trie(rows, base, checksum)
    assert max(d for _, d in got) > 100 and any(n > 1 for _, n, *_ in got.values())


def test_trie_without_heads_and_of_little(spark):
    rows = [(1, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "user", "b")]
    got = got_trie(trie.prefix_trie(frame(spark, rows, TURNS), lambda c: c, lambda c: F.lit(0), 1))
    assert got == plain_trie(rows, lambda c: c, lambda c: 0) and len(got) == 3
    one = [(7, None, None, None)]  # its only turn is replaced by nothing: a turnless conversation
    got = got_trie(trie.prefix_trie(frame(spark, one, TURNS), lambda c: c + 1, lambda c: F.lit(3), 3))
    assert got == {(7, 0): (None, 1, 0, 1, 0, sha("7"))}
    assert trie.prefix_trie(frame(spark, [], TURNS), lambda c: c, lambda c: F.lit(1), 1).count() == 0


def test_trie_survives_clashing_digests(spark, monkeypatch):
    """A digest that calls different turns equal is noticed, and another seed is taken."""
    real = trie._stored

    def weak(conversations, names, seed):
        out = real(conversations, names, seed)
        return out.withColumns({"x1": F.lit(1).cast("long"), "x2": F.lit(2).cast("long")}) if seed == 0 else out

    monkeypatch.setattr(trie, "_stored", weak)
    rows = [(c, t, "user", f"{c % 3}") for c in range(6) for t in range(2)]
    got = got_trie(trie.prefix_trie(frame(spark, rows, TURNS), lambda c: c, lambda c: F.lit(0), 1))
    assert got == plain_trie(rows, lambda c: c, lambda c: 0)


def test_op12_query(spark):
    got = queries.op12_conversation_prefix_trie(spark, SMALL)
    assert differences(got, connect(SMALL), queries.ORACLES["op12_conversation_prefix_trie"]) == []


# Structure repair -------------------------------------------------------------


def plain_faults(rows):
    """Rows (turn, role, text) in order with their first fault."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
    seen, out = set(), []
    for turn, role, text in rows:
        bare = text.strip("\t\n\x0b\x0c\r ")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((turn, role, text, fault))
    return out


def plain_repair(rows):
    """(cost, edits, kept rows) by a search from the end over every sequence of edits, two insertions at most between turns."""
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    @cache
    def best(i, state, made):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))

        def add(cost, edit, to, row, j, m):
            rest = best(j, to, m)
            if rest:
                found.append((cost + rest[0], edit + rest[1], (row, *rest[2]) if row else rest[2]))

        for kind in ("user", "assistant"):
            if made < 2 and kind[0] in step[state]:
                add(3, "I", kind[0], (kind, ""), i, made + 1)
        if i < len(rows):
            _, role, text, fault = rows[i]
            add(4, "D", state, None, i + 1, 0)
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                if role[:1] in step[state]:
                    add(more, "K", role[:1], (role, text), i + 1, 0)
                for kind in ("user", "assistant"):
                    if kind[0] in step[state]:
                        add(3 + more, "R", kind[0], (kind, text), i + 1, 0)
        return min(found, default=None)

    for i in reversed(range(len(rows))):  # from the end, so that no call goes deep
        for state in ("", "s", "u", "a"):
            best(i, state, 0)
    return best(0, "", 0)


def plain_audit(rows):
    f = plain_faults(rows)
    turns = [t for t, *_ in f if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    count = Counter(x[3] for x in f)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(f))
    cost, audit, kept = plain_repair(tuple(f))
    return gaps, count["blank"], count["duplicate"], count["truncated"], illegal, cost, audit, sha("\n".join(f"{r}:{t}" for r, t in kept))


def plain_damage(rows):
    out = defaultdict(list)
    for c, t, role, text in rows:
        own, role, text = out[c], " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if fate:
            text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
            own += [(t, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


AUDIT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def turns(seed, convs=120, longest=9):
    r = random.Random(seed)
    says = ["Yes.", "No!", "why", "  ", "", None, "Well?\n", "Fine. ", "cut of"]
    roles = ["user", "assistant", "user", "assistant", "system", "Tool", "", None, "sys", "usr"]
    rows = []
    for c in range(convs):
        for t in range(r.randint(0, longest)):
            text = r.choice(says) if r.random() < 0.4 else f"turn {r.random()}."
            rows.append((c, None if r.random() < 0.05 else t + r.choice([0, 0, 0, 1, 5]), r.choice(roles), text))
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_repair(spark, monkeypatch, seed):
    monkeypatch.setattr(repair, "LOOK", 2)
    monkeypatch.setattr(repair, "BATCH", 5)
    rows = turns(seed) + [(900, t, "user" if t % 2 == 0 else "assistant", f"{t}.") for t in range(400)]
    rows += [(901, t, r, f"{t}.") for t, r in enumerate(random.Random(seed).choices(["user", "assistant", "system"], k=300))]
    rows += [(None, 1, "user", "no id."), (None, 2, "user", "no id."), (77, 1, "user", "x."), (77, 1, "user", "x.")]
    df = frame(spark, rows, TURNS)
    damaged = queries.damaged(df)
    got = repair.repair(damaged, present_column="present").mapInArrow(queries._audits, queries._AUDIT).collect()
    expected = {c: plain_audit(own) for c, own in plain_damage(rows).items()}
    assert {r["conv_id"]: tuple(r[c] for c in AUDIT) for r in got} == expected and len(got) == len(expected)
    assert set("DIKR") <= {e for x in expected.values() for e in x[6]}


def test_repaired_rows(spark):
    rows = [(1, 0, "assistant", "Hi."), (1, 1, "assistant", "cut"), (1, 2, "user", "Hi."), (1, 2, "user", "Hi."), (2, 0, None, None)]
    got = repair.repair(frame(spark, rows, TURNS)).orderBy("conv_id", "n").collect()
    by = {c: [(r["edit"], r["role"], r["text"], r["fault"]) for r in got if r["conv_id"] == c] for c in (1, 2)}
    cost, audit, kept = plain_repair(tuple(plain_faults([r[1:] for r in rows if r[0] == 1])))
    assert "".join(e for e, *_ in by[1]) == audit and tuple(x[1:3] for x in by[1] if x[0] != "D") == kept
    assert sum(r["cost"] for r in got if r["conv_id"] == 1) == cost
    assert by[2] == [("D", " ", " ", "blank")]
    assert repair.repair(frame(spark, [], TURNS)).count() == 0


def test_repair_forgets_what_is_certain():
    """Undecided turns stay few in a long conversation, and nothing of the tree behind them is kept."""
    r = random.Random(4)
    for roles, blank in ((["user", "assistant"], 0.1), (["system", "user", "assistant", "x"], 0.3), (["user"], 0), (["x"], 1)):
        own, most = repair._Conversation(1), 0
        for t in range(10_000):
            own.add(t, r.choice(roles), f"{t}.", r.random() < blank, False, r.random() < 0.1)
            list(own.decided())
            most = max(most, len(own.waiting))
        assert most < 200 and own.search.root.depth > 9_800


def test_op13_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_structure_repair(spark, SMALL).collect()
    assert {r["conv_id"]: tuple(r[c] for c in AUDIT) for r in got} == {c: plain_audit(own) for c, own in plain_damage(rows).items()}
