"""Piece codec, prefix trie and turn repair against the library, plain loops and another algorithm."""

import hashlib
import random
import zlib
from functools import lru_cache

import numpy as np
import pytest
from pyspark.sql import functions as F

import oracle
from ranklab.llm import piece_codec, prefix_trie, turn_repair
from ranklab.llm.oracles import ORACLES
from ranklab.llm.queries import QUERIES, piece_model

CLASHING = ("kind", "key", "path", "sizes", "fault", "copy", "base", "h", "turns", "ids", "up", "shard")


def extra(df):
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING])


# --- 11 ---------------------------------------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_model())


def by_library(library, text):
    ids = library.encode(text or "", add_bos=True, add_eos=True)
    return ids, library.decode(ids)


def test_codec_on_whole_table(spark, sf, library):
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = QUERIES["op11_sentencepiece_codec"](spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids, text = by_library(library, texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_codec_on_random_texts(library):
    own = piece_codec.codec(piece_model())
    rng = random.Random(5)
    pieces = [p for p in own.rank if len(p) < 7]
    alphabets = ["ab", "the in", "  \t\n", "aeiou st▁", "αβγδ é漢字🙂\0 x", "0123456789.,", "abcdefghijklmnopqrstuvwxyz  ", "<s>/unk0xA"]
    texts = ["", " ", "▁", "▁▁ a", "<s>", "</s><0x0A>", "�", "\n", "\r\n\r\n", "a" * 3000, " " * 500, " " * 31 + "x", "=" * 999, "ab" * 700]
    texts += ["".join(rng.choice(a) for _ in range(rng.randint(1, 60))) for a in alphabets for _ in range(120)]
    texts += ["".join(rng.choice(pieces) for _ in range(rng.randint(1, 12))) for _ in range(1500)]
    for text in texts:
        ids, decoded = by_library(library, text)
        packed = own.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == ids, text
        assert own.decode(packed) == decoded, text


def test_codec_without_words(library):
    """A vocabulary whose pieces go on over spaces is encoded whole: here forced."""
    own = piece_codec.Codec(piece_model())
    own.cut = None
    rng = random.Random(6)
    for _ in range(200):
        text = "".join(rng.choice("the inéa \n🙂") for _ in range(rng.randint(1, 80)))
        assert np.frombuffer(own.encode(text), "<u4").tolist() == by_library(library, text)[0]


def test_decoding_broken_bytes(library):
    own = piece_codec.codec(piece_model())
    rng = random.Random(7)
    for _ in range(500):
        ids = [rng.choice([rng.randint(0, 258), rng.randint(195, 258), rng.randint(259, 31999), 28705, 1, 2]) for _ in range(rng.randint(0, 8))]
        assert own.decode(np.array(ids, "<u4").tobytes()) == library.decode(ids), ids


def test_codec_edges(spark, library):
    rows = [(1, None), (2, ""), (None, "a b"), (3, "a b"), (3, "a b"), (4, "the long tale " * 50000), (5, " \n")]
    docs = extra(spark.createDataFrame(rows, "doc_id long, text string"))
    out = piece_codec.decode(piece_codec.encode(docs, piece_model()), piece_model())
    assert sorted(map(str, ((r["doc_id"], r["n_tokens"], r["decoded"]) for r in out.collect()))) == sorted(
        map(str, ((i, len(by_library(library, t)[0]), t or "") for i, t in rows)))
    assert piece_codec.digest(piece_codec.decode(piece_codec.encode(docs.limit(0), piece_model()), piece_model())).count() == 0


# --- 12 ---------------------------------------------------------------------------------------------------

def plain_trie(rows):
    """`rows`: (conv_id, turn, role, text)."""
    own = {}
    for c, t, r, x in sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2] or "")):
        own.setdefault(c, []).append((r or "", x or ""))
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        built[c] = tuple(own.get(c - c % 5, [])[:h] + turns[h:])
    members, children = {}, {}
    for c, path in built.items():
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
    for node in members:
        if node:
            children.setdefault(node[:-1], set()).add(node)
    leaves, saved = dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node, own_members in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(own_members) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted((min(m), len(n), min(members[n[:-1]]) if n else -1, len(m), len(children.get(n, ())), leaves[n], saved[n],
                   hashlib.sha256(",".join(map(str, sorted(c for c in m if built[c] == n))).encode()).hexdigest()) for n, m in members.items())


def told(df):
    return sorted(tuple(-1 if r[c] is None else r[c] for c in prefix_trie.NODE) for r in df.collect())


def test_trie_equals_sql(spark, sf):
    assert oracle.compare(QUERIES["op12_conversation_prefix_trie"](spark, sf), oracle.connect(sf), ORACLES["op12_conversation_prefix_trie"]) is None
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert told(QUERIES["op12_conversation_prefix_trie"](spark, sf)) == plain_trie(rows)


@pytest.mark.parametrize("seed", range(4))
def test_trie_against_plain_loops(spark, seed, monkeypatch):
    """Few different turns: deep common beginnings, copies cut over many shards, conversations that end inside others."""
    rng = random.Random(seed)
    rows = []
    for c in range(rng.choice([1, 40, 250])):
        n = rng.choice([0, 1, 2, 9, 12, 14]) if seed else 14
        rows += [(c, t, rng.choice(["user", None]), rng.choice(["é", "xy"]) if rng.random() < 0.15 else "same") for t in range(n)]
    rows += [(700 + 5 * i, t, "u", "one") for i in range(60) for t in range(10)]                      # one set of copies
    rows += [(5000, t, "u", f"t{t}") for t in range(300)]
    monkeypatch.setattr(prefix_trie, "SHARD_TURNS", 50)
    monkeypatch.setattr(prefix_trie, "CHUNK_IDS", 7)
    df = extra(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)
    assert told(prefix_trie.trie(df)) == plain_trie(rows)


def test_trie_edges(spark):
    kind = "conv_id long, turn long, role string, text string"
    rows = [(0, None, None, None), (0, 2, "user", "b"), (1, 1, "user", ""), (None, 1, "user", "lost"), (7, 1, "a", "long " * 100000), (3, 5, "u", "x"), (3, 5, "u", "x")]
    df = extra(spark.createDataFrame(rows, kind))
    assert told(prefix_trie.trie(df)) == plain_trie([r for r in rows if r[0] is not None])
    assert prefix_trie.trie(df.limit(0)).count() == 0
    assert prefix_trie.trie(df.where("conv_id is null")).count() == 0


def test_findclose_and_leaves():
    rng = random.Random(1)
    for n in (1, 5, 700, 70000):
        bits, depth = [], 0
        while len(bits) < 2 * n:
            up = depth == 0 or (rng.random() < 0.5 and len(bits) + depth < 2 * n)
            if len(bits) + depth >= 2 * n:
                up = False
            bits.append(up)
            depth += 1 if up else -1
        tree, stack, close = prefix_trie.Parentheses(np.array(bits)), [], {}
        for i, b in enumerate(bits):
            if b:
                stack.append(i)
            else:
                close[stack.pop()] = i
        for at in rng.sample(sorted(close), min(len(close), 400)):
            assert tree.findclose(at) == close[at]
            if close[at] - at < 2000:
                assert tree.leaves(at, close[at]) == sum(bits[i] and not bits[i + 1] for i in range(at, close[at]))


# --- 13 ---------------------------------------------------------------------------------------------------

def by_states(pattern):
    """Least (cost, audit) over the grammar's states instead of target lengths."""
    @lru_cache(None)
    def best(i, state, inserted):
        found = []
        if i == len(pattern) and state in ("start", "a"):
            found.append((0, ""))
        if inserted < 3 and not (state == "start" and inserted):
            after = {"start": "u", "s": "u", "u": "a", "a": "u"}[state]
            cost, audit = best(i, after, inserted + 1)
            found.append((cost + 3, "I" + audit))
        if i < len(pattern):
            c = pattern[i]
            cost, audit = best(i + 1, state, inserted)
            found.append((cost + 4, "D" + audit))
            if c != "-":
                extra_ = 3 * c.isupper()
                expected = {"start": "us", "s": "u", "u": "a", "a": "u"}[state]
                for e in expected:
                    if c.lower() == e:
                        cost, audit = best(i + 1, e, 0)
                        found.append((cost + extra_, "K" + audit))
                    elif e != "s":
                        cost, audit = best(i + 1, e, 0)
                        found.append((cost + extra_ + 3, "R" + audit))
        return min(found, default=(10 ** 6, ""))

    return best(0, "start", 0)


def test_alignment_against_states():
    rng = random.Random(2)
    patterns = ["", "s", "-", "x", "S", "u", "a", "U", "ua", "sua", "--", "ssss", "au"]
    patterns += ["".join(rng.choice("uauauasx-UASX") for _ in range(rng.randint(1, 14))) for _ in range(3000)]
    patterns += ["s" + "ua" * 20, "ua" * 30 + "u", "".join(rng.choice("ua") for _ in range(80)), "u" * 41, "a" * 30, "s" * 25, "x" * 33]
    for p in patterns:
        assert turn_repair.with_faults(p) == by_states(p), p


def test_long_conversations_align():
    rng = random.Random(3)
    for n in (500, 2500):
        p = "".join(rng.choice("-xUuauasa") if rng.random() < 0.2 else "ua"[i % 2] for i in range(n))
        cost, audit = turn_repair.with_faults(p)
        paid = {"K": 0, "R": 3, "D": 4, "I": 3}
        kept = iter(p)
        total = 0
        for e in audit:
            c = next(kept) if e != "I" else ""
            total += paid[e] + (3 if c.isupper() and e != "D" else 0)
            assert c != "-" or e == "D"
        assert total == cost and next(kept, None) is None
        final = turn_repair.repaired(audit, [{"u": "user", "a": "assistant", "s": "system"}.get(c.lower(), "x") for c in p], list(p))
        roles = "".join(r[0] for r, _ in final)
        assert roles.removeprefix("s") == "ua" * (len(roles) // 2) and len(roles) != 1


def plain_repair(rows):
    own = {}
    for c, t, r, x in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        turns = own.setdefault(c, [])
        if kind == 0:
            continue
        x = "" if kind == 1 else "".join(k for k in x if k not in ".!?") if kind == 2 else x
        turns += [(t, "user" if kind == 4 else r, x)] * (2 if kind == 3 else 1)
    out = []
    for c, turns in own.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, pattern, counts, illegal = set(), "", {"-": 0, "d": 0, "t": 0}, 0
        for n, (t, r, x) in enumerate(turns):
            bare = x.strip(" \t\n\v\f\r")
            letter = r[:1] if r[:1] in ("s", "u", "a") else "x"
            if not bare:
                counts["-"] += 1
                letter = "-"
            elif (r, x) in seen:
                counts["d"] += 1
                letter = "-"
            elif bare[-1] not in ".!?":
                counts["t"] += 1
                letter = letter.upper()
            pattern += letter
            seen.add((r, x))
            illegal += n > 0 and turns[n - 1][1][:1] + r[:1] not in ("su", "ua", "au")
        cost, audit = by_states(pattern)
        final, at, size = [], 0, sum(e != "D" for e in audit)
        for e in audit:
            role = "user" if (len(final) - size % 2) % 2 == 0 else "assistant"
            if e == "I":
                final.append(role + ":")
                continue
            if e != "D":
                final.append((turns[at][1] if e == "K" else role) + ":" + turns[at][2])
            at += 1
        numbers = {t for t, _, _ in turns if t is not None}
        out.append((c, max(numbers) - min(numbers) + 1 - len(numbers) if numbers else 0, counts["-"], counts["d"], counts["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(final).encode()).hexdigest()))
    return sorted(out, key=str)


def test_repair_against_plain_loops(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = QUERIES["op13_conversation_repair"](spark, sf)
    assert out.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted(map(tuple, out.collect()), key=str) == plain_repair(rows)


def test_repair_edges(spark):
    rng = random.Random(4)
    texts = [None, "", "a.", "b!", "no end", " \t", "end?\n", "x.\u0085", " \u0085", "a. ", "long tale. " * 30000]
    rows = [(rng.choice([None, 1, 2, 3, -7]), rng.choice([None, 1, 2, 5, 90]), rng.choice([None, "", "user", "assistant", "system", "tool", "U"]), rng.choice(texts))
            for _ in range(60)]
    rows += [(c, t, "user", "a.") for c in range(100, 140) for t in range(2)] + rows[:4]
    df = extra(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).repartition(3)
    got = turn_repair.digest(turn_repair.repair(turn_repair.damage(df)))
    assert sorted(map(tuple, got.collect()), key=str) == plain_repair(rows)
    assert turn_repair.repair(turn_repair.damage(df.limit(0))).count() == 0
