"""The prefix trie against brute force over all beginnings, and the radix tree by itself."""

import hashlib
import random
import re
import zlib

import pytest

from countersign.llm import oracle
from countersign.llm.prefix_trie import Inner, RadixTree, ids_sha256, numbered_turns, prefix_trie
from countersign.llm.queries import op11_prefix_trie, rebuilt_turns
from tests.compare_engines import problem

DATA = "/root/testdata/sf0.001"
COLUMNS = "conv_id bigint, turn int, role string, text string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def in_order(rows):
    """Turns of each conversation; equal turn numbers by the digest of role and text."""
    convs = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            convs.setdefault(conv, []).append((turn is not None, turn or 0, sha(f"{len(role or '')}:{role or ''}{text or ''}"), (role or "", text or "")))
    return {c: [t[3] for t in sorted(turns)] for c, turns in convs.items()}


def rebuilt(convs):
    out = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        out[c] = convs.get(base, [])[:h] + own[h:]
    return out


def brute(paths):
    members = {}
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members.setdefault(tuple(path[:d]), []).append(c)
    children = {n: [m for m in members if len(m) == len(n) + 1 and m[: len(n)] == n] for n in members}
    out = set()
    for node, convs in members.items():
        below, queue = [], [node]
        while queue:
            n = queue.pop()
            below.append(n)
            queue.extend(children[n])
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = sorted(c for c in convs if len(paths[c]) == len(node))
        out.add((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), len(children[node]),
            sum(not children[n] for n in below), saved, sha(",".join(map(str, ends))),
        ))
    return out


def found(nodes, ends):
    fields = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    hashes = {r.name: r.ends_sha256 for r in ids_sha256(ends, chunk=3).collect()}
    rows = [tuple(r[f] for f in fields) + (hashes.get(r.name, sha("")),) for r in nodes.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_query_against_sql(spark):
    assert problem(spark, DATA, op11_prefix_trie, oracle.prefix_trie()) is None


@pytest.mark.parametrize("segment, tree_bytes", [(256, 8 << 20), (2, 8 << 20), (1, 40), (3, 1)])
def test_any_cut_gives_the_same_trie(spark, segment, tree_bytes):
    drawn = random.Random(segment)
    rows = []
    for conv in list(range(-25, 60)) + [10**15, -(10**15)]:
        for turn in range(drawn.randrange(9)):
            text = f"said {drawn.randrange(2)}" if turn < 4 else f"then {drawn.randrange(3)} more \x0bwords"
            rows.append((conv, turn, drawn.choice(["user", "user", "assistant"]), text))
    rows += [(100 + i, turn, "user", f"same {turn}") for i in range(30) for turn in range(7)]  # a group of copies
    rows += [(200, turn, "user", f"same {turn}") for turn in range(40)]  # a long one that goes on where they end
    df = spark.createDataFrame(rows, COLUMNS).repartition(5)
    convs = in_order(rows)
    assert found(*prefix_trie(*numbered_turns(df), segment, tree_bytes)) == brute(convs)
    assert found(*prefix_trie(*rebuilt_turns(df), segment, tree_bytes)) == brute(rebuilt(convs))


def test_odd_conversations(spark):
    long_text = "word " * 30_000
    rows = [
        (1, None, None, None), (1, 0, "user", ""), (1, 0, "user", ""), (1, 1, "us", "erx"), (1, 1, "user", "x"), (2, 0, "", None),
        (None, 0, "user", "no id"), (3, 5, "user", long_text), (3, 4, "user", long_text + "."), (7, -1, "a", "b"), (27, 3, "a", "b"),
        (7, 2**31 - 1, "é", "ü \t\n   ß"),
    ]
    df = spark.createDataFrame([(*r, 1, "n", 2) for r in rows], COLUMNS + ", pos int, name string, place int")
    convs = in_order(rows)
    assert found(*prefix_trie(*numbered_turns(df))) == brute(convs)
    assert found(*prefix_trie(*rebuilt_turns(df))) == brute(rebuilt(convs))
    nodes, ends = prefix_trie(*rebuilt_turns(df.limit(0)))
    assert nodes.count() == 0 and ids_sha256(ends).count() == 0


def test_only_turnless_conversations(spark):
    # Conversations whose own turns are all replaced, by those of one that is not there.
    convs = [c for c in range(21, 400) if zlib.crc32(str(c).encode()) % 4 == 3 and c % 20][:3]
    df = spark.createDataFrame([(c, 0, "user", "gone") for c in convs], COLUMNS)
    assert found(*prefix_trie(*rebuilt_turns(df))) == {(convs[0], 0, None, 3, 0, 1, 0, sha(",".join(map(str, convs))))}


def test_layouts_grow_and_paths_stay_whole():
    drawn = random.Random(5)
    keys = {bytes(drawn.randrange(256) for _ in range(1)) + b"tail" * drawn.randrange(4) + bytes([drawn.randrange(4)]) for _ in range(3000)}
    keys |= {b"", b"tail", b"tailtail"}
    tree = RadixTree()
    listed = sorted(keys, key=lambda k: drawn.random())
    assert [tree.add(k, i) for i, k in enumerate(listed)] == list(range(len(listed)))
    assert [tree.add(k, -1) for k in listed] == list(range(len(listed)))
    walked = list(tree.from_below())
    assert sorted(ended for _, _, _, ended in walked if ended is not None) == list(range(len(listed)))
    assert isinstance(tree.root, Inner) and tree.root.size == 256
    for width, size in ((3, 4), (11, 16), (40, 48), (49, 256)):
        small = RadixTree()
        for byte in drawn.sample(range(256), width):
            small.add(bytes([7, byte]), byte)
        assert small.root.path == b"\x07" and small.root.size == size
        assert [b for b, _ in small.root.children()] == sorted(b for b, _ in small.root.children())
        assert all(small.add(bytes([7, b]), -1) == b for b, _ in small.root.children())
    # Children come before their parents, and every node but the root is somebody's child.
    for number, (_, _, children, _) in enumerate(walked):
        assert all(child < number for child in children)
    assert sorted(c for _, _, children, _ in walked for c in children) == list(range(len(walked) - 1))
