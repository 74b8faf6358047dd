"""The Merkle manifest against a plain tree built on the driver."""

import hashlib
import zlib
from collections import Counter

import pytest

from quillstack.llm import merkle


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    fields = (row["doc_id"], row["source"], row["lang"], row["n_chars"], text)
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def tree(nodes):
    """The top, and of every node its (before, after) siblings level by level."""
    paths, groups = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(i, min(i + 3, len(nodes))) for i in range(0, len(nodes), 3)]
        for run in runs:
            for k in run:
                for m in groups[k]:
                    paths[m].append(([nodes[x] for x in run if x < k], [nodes[x] for x in run if x > k]))
        nodes, groups = [digest(*[nodes[x] for x in run]) for run in runs], [[m for x in run for m in groups[x]] for run in runs]
    return nodes[0], paths


def expected(rows):
    by_source = {}
    for r in rows:
        order = (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]))
        by_source.setdefault(r["source"], []).append((order, r))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    inside = {}
    for s in names:
        by_source[s].sort(key=lambda x: x[0])
        inside[s] = tree([order[2] for order, _ in by_source[s]])
    root, across = tree([inside[s][0] for s in names])
    for s, top in zip(names, across, strict=True):
        for (order, r), path in zip(by_source[s], inside[s][1], strict=True):
            path, node = path + top, order[2]
            if r["doc_id"] is not None and r["text"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0:
                node = leaf(r, r["text"].replace("\n", ""))
            for before, after in path:
                node = digest(*before, node, *after)
            proof = digest(*[x for before, after in path for x in (*before, *after)])
            yield (r["doc_id"], order[2], inside[s][0], root, proof, node, node == root)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest_matches_a_plain_tree(docs, monkeypatch, levels):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", levels)
    rows = docs.collect()
    got = Counter(tuple(r) for r in merkle.query(docs).collect())
    assert got == Counter(expected(rows))
    assert 0 < sum(n for r, n in got.items() if r[-1]) < len(rows)


def test_odd_rows(odd, empty, monkeypatch):
    monkeypatch.setattr(merkle, "BLOCK_LEVELS", 1)
    assert Counter(tuple(r) for r in merkle.query(odd).collect()) == Counter(expected(odd.collect()))
    assert merkle.query(empty).collect() == []


def test_one_source_of_one_row(docs):
    one = docs.limit(1)
    (row,) = merkle.manifest(one, merkle.Workspace(one.sparkSession)).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == digest("")
