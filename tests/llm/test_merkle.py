"""The Merkle manifest against a plain recursion over lists."""

import random
from hashlib import sha256
from zlib import crc32

import pytest
from pyspark.sql import functions as F
from stewardry.llm import merkle
from stewardry.llm.staging import prepare

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, raw string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def climb(nodes):
    """Root and, for each node, its (place, siblings) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for k, path in enumerate(paths):
            run, place = nodes[at[k] // 8 * 8 :][:8], at[k] % 8
            path.append((place, run[:place] + run[place + 1 :]))
            at[k] //= 8
        nodes = [h(*nodes[j : j + 8]) for j in range(0, len(nodes), 8)]
    return nodes[0], paths


def plain(rows):
    trees, out = {}, []
    for doc_id, source, lang, n_chars, text in rows:
        low = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf = h(*map(field, (doc_id, source, lang, n_chars, text)))
        tampered = doc_id is not None and crc32(str(doc_id).encode()) % 3 == 0
        shown = h(*map(field, (doc_id, source, lang, n_chars, low))) if tampered else leaf
        trees.setdefault(lang, []).append(((doc_id is not None, doc_id or 0), leaf, shown, doc_id))
    langs = sorted(trees, key=lambda lang: (lang is not None, (lang or "").encode()))
    subs = {lang: climb([leaf for _, leaf, _, _ in sorted(trees[lang])]) for lang in langs}
    if not langs:
        return out
    root, top = climb([subs[lang][0] for lang in langs])
    for lang, above in zip(langs, top):
        for (_, leaf, shown, doc_id), path in zip(sorted(trees[lang]), subs[lang][1]):
            fold = shown
            for place, others in path + above:
                fold = h(*others[:place], fold, *others[place:])
            proof = h(*[d for _, others in path + above for d in others])
            out.append((doc_id, lang, leaf, subs[lang][0], root, proof, fold, fold == root))
    return out


def proven(spark, rows):
    given = spark.createDataFrame([(*r, "t", "r") for r in rows], SCHEMA)
    named = [merkle.field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")]
    leaf = merkle.digest(*named, merkle.field(F.col("text")))
    low = merkle.digest(*named, merkle.field(merkle.lower_ascii(F.col("text"))))
    shown = F.when(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, low).otherwise(leaf)
    return sorted(map(tuple, merkle.manifest(given, "doc_id", "lang", leaf, shown).collect()), key=repr)


def mixed():
    draw = random.Random(3)
    texts = [None, "", "Abc É", "x", "Å" * 2000 + "Z", "y" * 50_000 + "Q"]
    rows = [(i, "s", draw.choice(["en", "de", None, "é", ""]) if i % 3 else "en", i, draw.choice(texts)) for i in range(300)]
    return rows + [(None, None, None, None, None)] * 3 + [(None, "a", "en", 1, "T"), (3, "s", "en", 3, "q"), (-4, "s", "en", 3, "Q")]


@pytest.mark.parametrize(
    "rows",
    [
        [],
        [(5, None, None, None, None)],
        [(5, "a", "en", 1, "A"), (6, "b", None, 2, "É B")],
        [(i, "s", "en", i, f"Text {i}") for i in range(9)],
        [(i, "s", f"l{i}", i, "T") for i in range(20)],
        mixed(),
    ],
    ids=["empty", "one", "two trees", "last run of one", "lone leaves", "mixed"],
)
def test_manifest_is_the_plain_one(spark, rows):
    assert proven(prepare(spark), rows) == sorted(plain(rows), key=repr)


def test_only_letters_from_a_to_z_are_lowered(spark):
    texts = ["ABZ az", "É ABZ", "", None, "İSTANBUL", "[@`{"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(merkle.lower_ascii(F.col("t"))).collect()
    assert [r[0] for r in rows] == ["abz az", "É abz", "", None, "İstanbul", "[@`{"]
