from __future__ import annotations

import random

from brindle.llm.leak import LeakRules, leaked_items
from brindle.llm.text import plain_words, shingles, hash_words


def sentence(rng, n):
    return [f"w{rng.randrange(4000)}" for _ in range(n)]


def disguise(words, rng):
    out = []
    for i, w in enumerate(words):
        k = rng.random()
        out.append(w.upper() if k < 0.2 else f"[[Page|{w}]]" if k < 0.3 else f"''{w}''" if k < 0.4 else w[0] + "­" + w[1:] if k < 0.5 else f"{w}<ref name='x'>Note {i}</ref>" if k < 0.55 else w + "&#44;" if k < 0.6 else w)
    return "&nbsp; ".join(" \n".join(out[i : i + 9]) for i in range(0, len(out), 9))


def test_planted_passages(spark):
    rng = random.Random(2)
    items = {i: sentence(rng, rng.randint(50, 120)) for i in range(30)}
    stock = ["choose", "the", "best", "answer", "from", "the", "options"]
    items = {i: (stock + w if i % 3 == 0 else w) for i, w in items.items()}
    items[30] = items[7][: len(items[7]) // 2] + sentence(rng, 30)
    docs, want = [], set()
    for d in range(200):
        words = sentence(rng, rng.randint(0, 300))
        i = rng.randrange(30)
        part = rng.choice([0.0, 0.3, 0.62, 0.9, 1.0])
        w = items[i]
        start = rng.randrange(len(w) - int(part * len(w)) + 1)
        passage = list(w[start : start + int(part * len(w))])
        for _ in range(len(passage) // 20):
            passage[rng.randrange(len(passage))] = "altered"
        text = " ".join(words[:50]) + " " + disguise(passage, rng) + " " + " ".join(words[50:])
        docs.append((d, text))
        if part > 0.5:
            want.add((d, i))
    docs += [(1000, None), (1001, ""), (None, " ".join(items[1])), (1002, " ".join(items[7])), (1002, " ".join(items[7])), (1003, "w " * 100_000), (1004, " ".join(stock) + " " + " ".join(sentence(rng, 90)))]
    want |= {(1002, 7)}
    df = spark.createDataFrame([(*d, 5, []) for d in docs], "doc_id bigint, text string, item_id int, words array<bigint>")
    tests = spark.createDataFrame([(i, "s", " ".join(w)) for i, w in items.items()] + [(7, "s", " ".join(items[7])), (98, "s", None), (99, "s", "too short"), (None, "s", "x")], "item_id bigint, suite string, text string")
    found = {tuple(r) for r in leaked_items(df, "doc_id", "text", tests, "item_id", "text").collect()}
    near = {(d, 30) for d, i in want if i == 7}  # item 30 shares its first half with item 7
    assert want <= found and found - want <= near
    blocks = {tuple(r) for r in leaked_items(df, "doc_id", "text", tests, "item_id", "text", LeakRules(block_words=400)).collect()}
    assert blocks == found
    assert leaked_items(df.limit(0), "doc_id", "text", tests, "item_id", "text").count() == 0
    assert leaked_items(df, "doc_id", "text", tests.limit(0), "item_id", "text").count() == 0


def test_surface_form_does_not_count():
    assert plain_words("The [[Foo|quick]] ''brown''<ref>x y</ref> f­o​x&nbsp;jumps&#44; <b>OVER</b>") == ["the", "quick", "brown", "fox", "jumps", "over"]
    assert plain_words(None) == [] == plain_words("")
    assert len(shingles(hash_words(["a"] * 4), 5)) == 0 and len(shingles(hash_words(["a"] * 9), 5)) == 5


def test_notes_comments_and_broken_markup_keep_their_words(spark):
    rng = random.Random(4)
    item, rest = sentence(rng, 40), " ".join(sentence(rng, 30))
    text = " ".join(item)
    docs = [
        f"{rest}<ref name='n'>{text}</ref> {rest}", f"{rest} <!-- {text} --> {rest}", f"{rest} <ref>open {text} {rest} <ref>Note</ref> end", f"{rest} a < b {text} c > d {rest}", f"{rest} <!-- open {text}",
        " ".join(item[:20]) + f"<ref>{rest}</ref> " + " ".join(item[20:]), f"{rest} <ref>{rest}</ref>",
    ]
    found = leaked_items(spark.createDataFrame(list(enumerate(docs)), "doc_id bigint, text string"), "doc_id", "text", spark.createDataFrame([(1, text)], "item_id bigint, text string"), "item_id", "text")
    assert sorted(r["doc_id"] for r in found.collect()) == [0, 1, 2, 3, 4, 5]
    assert plain_words("one<ref>a b c d e</ref> two <br/> <b class='x'>three</b>") == ["one", "two", "three", "a", "b", "c", "d", "e"]


def altered(passage, share, rng):
    """A passage with so many of its inner words replaced; both ends stay."""
    n = int(share * len(passage)) if share < 1 else int(share)
    out = list(passage)
    for k in rng.sample(range(1, len(out) - 1), min(n, max(0, len(out) - 2))):
        out[k] = f"zz{rng.randrange(10**6)}"
    return out


def recall(spark, cells, seed, each=12):
    """Share of the planted passages that are found, by (words of the item, kind)."""
    rng = random.Random(seed)
    items, docs, want = {}, [], {}
    for words, kind, part, share in cells:
        for _ in range(each):
            k = len(items)
            items[k] = sentence(rng, words)
            need = max(2, -(-words // 2)) if part < 1 else words
            start = rng.randrange(words - need + 1)
            passage = altered(items[k][start : start + need], share, rng)
            docs.append((k, disguise(sentence(rng, 60) + passage + sentence(rng, 60), rng)))
            want.setdefault((words, kind), []).append(k)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    tests = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id bigint, text string")
    found = {tuple(r) for r in leaked_items(df, "doc_id", "text", tests, "item_id", "text").collect()}
    return {cell: sum((k, k) in found for k in ks) / len(ks) for cell, ks in want.items()}


def test_items_of_every_length(spark):
    cells = []
    for words in (2, 3, 4, 5, 6, 8, 10, 12, 16, 18, 20, 24, 40):
        cells += [(words, "whole", 1, 0), (words, "half", 0.5, 0)]
        if words >= 3:
            cells.append((words, "whole, one altered", 1, 1))
        if words >= 5:
            cells.append((words, "half, one altered", 0.5, 1))
    got = recall(spark, cells, 3)
    assert min(got.values()) >= 0.9, got


def test_altered_shares(spark):
    cells = [(words, f"{kind} {share}", part, share) for words in (20, 40, 80, 160) for kind, part in (("half", 0.5), ("whole", 1)) for share in (0.05, 0.1, 0.15, 0.2)]
    got = recall(spark, cells, 4)
    assert min(v for (_, kind), v in got.items() if not kind.endswith(" 0.2")) == 1.0 and min(got.values()) >= 0.9, got
    most = recall(spark, [(words, str(share), 0.5, share) for words in (40, 80, 160) for share in (0.3, 0.4)], 5)
    assert max(most.values()) == 0.0, most


def test_prefix_and_count_lose_nothing():
    """Of a passage with the most alterations, spread or in one place, at least the promised shingles are left."""
    rng, rules = random.Random(6), LeakRules()
    for words in range(2, 200):
        size, kept = rules.shingle(words)
        assert 1 <= rules.joint(kept) <= max(1, kept)
        for span in {rules.passage(words), words, rng.randint(rules.passage(words), words)}:
            for _ in range(5):
                away = set(rng.sample(range(span), rules.may_alter(span)))
                if size > 1:
                    assert sum(not away & set(range(k, k + size)) for k in range(span - size + 1)) >= kept
                assert span - len(away) >= 1


def test_edges_of_items_and_documents(spark):
    tests = spark.createDataFrame([(1, "zyx"), (2, "wvu tsr"), (3, "a b a b a b a b"), (4, "!!!"), (5, "")], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, "x Zyx y"), (2, "wvu x"), (3, "TSR, wvu tsr"), (4, "a b " * 20_000), (5, "a"), (6, "<ref>wvu tsr</ref>")], "doc_id bigint, text string")
    found = {tuple(r) for r in leaked_items(docs, "doc_id", "text", tests, "item_id", "text").collect()}
    assert found == {(1, 1), (3, 2), (4, 3), (6, 2)}
