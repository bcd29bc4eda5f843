from __future__ import annotations

import random

import numpy as np

from brindle.llm.spam import SpamRules, corpus_company, matter_shares, spam_pages


def prose(rng, n):
    parts = [["The council of", "An early mill near", "Most of the weavers from"], ["passed by inheritance to", "is fed by springs above", "was merged with the parish of"], ["according to a note of", "where shepherds still meet near", "though records differ about"]]
    return " ".join(f"{rng.choice(parts[0])} Xan{rng.randrange(999)} {rng.choice(parts[1])} Yor{rng.randrange(999)}, {rng.choice(parts[2])} {rng.randrange(1200, 1999)}." for _ in range(n))


TOPIC = "casino pills replica wholesale coupon shipping mattress insurance outlet discount flights watches".split()


def spam(rng, kind):
    pick = lambda n: rng.choices(TOPIC, k=n)
    if kind == "salad":
        return " ".join(pick(150))
    if kind == "links":
        return "\n".join(f"* [http://www.{rng.choice(TOPIC)}{rng.randrange(99)}.example/{rng.choice(TOPIC)}{rng.randrange(99)}.html {' '.join(pick(2))}]" for _ in range(30))
    if kind == "categories":
        return "\n".join(f"[[Category:{' '.join(w.title() for w in pick(2))} Zor{rng.randrange(999)}]]" for _ in range(30))
    if kind == "labels":
        return " | ".join(f"#{a}{b}" for a, b in zip(pick(60), pick(60), strict=True))
    return "; ".join(rng.choice(["car rental near", "best car rental", "car rental"]) + f" Zor{rng.randrange(999)}" for _ in range(60))


def test_planted_pages(spark):
    rng = random.Random(4)
    kinds = ["salad", "links", "categories", "labels", "phrases"]
    rows, want = [], set()
    for i in range(300):
        rows.append((i, prose(rng, rng.randint(3, 12))))
    for i in range(300, 380):
        rows.append((i, prose(rng, 1) + "\n\n" + spam(rng, kinds[i % 5]) + ("\n" + prose(rng, 1) if i % 2 else "")))
        want.add(i)
    few = 380
    for i in range(few, few + 20):  # less than half of the text
        rows.append((i, prose(rng, 14) + "\n" + " ".join(rng.choices(TOPIC, k=25))))
    rows += [
        (500, None), (501, ""), (502, "  \n"), (503, "pills pills pills"), (504, "{| class='wikitable'\n" + "\n".join(f"| {rng.randrange(9999)} || Nam{rng.randrange(999)} || –" for _ in range(40)) + "\n|}"),
        (505, "\n".join(f"* [[Xan{k} (mill)]], a mill in Yor{k} that was merged with the parish of Zan{k}" for k in range(12))), (506, "".join("".join(rng.choices("山川石谷橋村島寺塔町古北", k=14)) + "。" for _ in range(40))), (None, " ".join(TOPIC * 20)), (507, "#REDIRECT [[Xan]]"), (508, "pills " * 30_000),
    ]
    want.add(508)
    df = spark.createDataFrame([(*r, 0.1) for r in rows], "doc_id bigint, text string, matter double")
    found = {r["doc_id"] for r in spam_pages(df, "doc_id", "text").collect()}
    assert found - {None} == want
    assert spam_pages(df.limit(0), "doc_id", "text").count() == 0


def test_shares_do_not_depend_on_batches(spark):
    rng = random.Random(6)
    texts = [prose(rng, 5) for _ in range(40)] + [spam(rng, "salad"), None, ""]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    company = corpus_company(df, SpamRules())
    whole = matter_shares(texts, company, SpamRules())
    assert np.allclose(whole, [matter_shares([t], company, SpamRules())[0] for t in texts])
    assert whole[40] > 0.9 and max(whole[:40]) < 0.2


GRAMMAR = {
    "en": ["the council of {} passed by inheritance to the parish near {}", "an early mill near {} is fed by springs above the road to {}", "most of the weavers from {} were merged with the guild of {} though records differ", "a survey of {} was measured against the old chapel where shepherds still meet near {}"],
    "de": ["der Fluss {} entspringt unterhalb der alten Kirche von {} und treibt drei Mühlen", "die Gemeinde {} gehört seit jeher zum Kreis {} und zählt wenige Einwohner", "über den Ursprung des Namens {} herrscht unter den Lehrern von {} keine Einigkeit", "das Dorf {} wurde nach dem Brand neben der Straße nach {} wieder erbaut"],
}
NAMES = [a + b for a in ("Xan", "Yor", "Zel", "Bri", "Kro", "Lum", "Tam", "Wyn") for b in ("dor", "vel", "mar", "thi", "oss", "quil")]


def sentences(rng, lang, n):
    return " ".join(rng.choice(GRAMMAR[lang]).format(rng.choice(NAMES), rng.choice(NAMES)).capitalize() + "." for _ in range(n))


def test_salad_of_known_words(spark):
    """Keywords once or twice each and shuffled sentences say nothing of each other, whatever the language."""
    rng = random.Random(8)
    pages = [(k, sentences(rng, "en" if k % 6 else "de", rng.randint(6, 14))) for k in range(600)]
    want, kept = set(), len(pages)
    shops = [f"shopword{a}{b}" for a in "abcdefgh" for b in "klmnopqr"]
    for lang in ("en", "de"):
        words = sorted({w.strip(".").lower() for k, t in pages if (k % 6 > 0) == (lang == "en") for w in t.split()})
        for _ in range(20):
            whole = sentences(rng, lang, 12).replace(".", "").split()
            for made in (rng.sample(words, min(120, len(words))), rng.sample(whole, len(whole)), rng.sample(shops * 2, 2 * len(shops))):
                pages.append((len(pages), " ".join(made)))
                want.add(len(pages) - 1)
    tables = len(pages)
    for _ in range(30):  # tables and lists of names, and sentences in a language the corpus does not have
        pages.append((len(pages), "{| class=\"wikitable\"\n! Name !! Height !! Place\n" + "\n".join(f"|-\n| {rng.choice(NAMES)} || {rng.randrange(9999)} || {rng.choice(NAMES)}" for _ in range(20)) + "\n|}"))
        pages.append((len(pages), "\n".join(f"* [[{rng.choice(NAMES)}]], {rng.choice(GRAMMAR['en']).format(rng.choice(NAMES), rng.choice(NAMES))}" for _ in range(9))))
        pages.append((len(pages), " ".join("".join(rng.choices("aeioukstnlm", k=rng.randint(2, 9))) for _ in range(90))))
    found = {r["doc_id"] for r in spam_pages(spark.createDataFrame(pages, "doc_id bigint, text string"), "doc_id", "text").collect()}
    assert not {d for d in found if d < kept or d >= tables}
    for part in range(6):
        mine = {d for d in want if (d - kept) // 60 == part // 3 and (d - kept) % 3 == part % 3}
        assert len(mine & found) >= 0.9 * len(mine), (part, len(mine & found), len(mine))
