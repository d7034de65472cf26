import random
import re
from difflib import SequenceMatcher

from carelattice.llm import license_vote as L

WORDS = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def base(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for phrase, label in L.PHRASES for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_scan(docs, odd_rows):
    rows = [
        *odd_rows, (20, "Some prose. ALL RIGHTS reserved, cc-BY and CC by; the general\npublic  license"), (21, "éé " * 30 + "Released under the MIT License. " * 3),
        (22, "intro words " * 9 + "Licensed under the Apache License, Version 2.0 (the License); you may not use this tiny file except in compliance with the License"), (23, "MIT is a school"),
        (24, "Released under the MIT License"), (24, "Released under the MIT License"), (25, "a license version of the general work under this"),
    ]
    got = L.scan(docs(rows)).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, set()).add(t)
    assert len(got) == len(rows)
    for r in got:
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) in {base(t) for t in texts[r["doc_id"]]}
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(",")) | {""} and 0 <= r["score"] <= 1
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert labels[20] == "cc-by,gpl,reserved" and labels[21] == "mit" and labels[22] == "apache-2.0" and labels[24] == "mit"
    assert labels[1] == labels[6] == labels[23] == labels[25] == ""
    spans = next(r["spans"] for r in got if r["doc_id"] == 24)
    assert [(s["start"], s["end"], s["share"]) for s in spans] == [(0, 5, 1.0)]


def test_empty_table(docs):
    assert L.scan(docs([(1, "a")]).where("false")).collect() == []


def test_notices_without_enough_votes(docs):
    bsd = L.words_of(dict(L.TEMPLATES)["bsd"])
    changed = " ".join(w if i % 3 else "other" for i, w in enumerate(bsd))
    apart = " ".join([*bsd[:7], "which of course includes every copy made", *bsd[7:13], "as we have said many times before", *bsd[13:]])
    rows = [
        (1, "Released under the Expat MIT License"), (2, "Released under an MIT License"), (3, "long prose before it " * 40 + changed + " and after it" * 40), (4, apart),
        (7, "Released under an MIT License. " * 2), (5, "It is distributed under the terms of the usual license"), (6, "Released under the Apache License"),
    ]
    got = L.scan(docs(rows)).collect()
    labels = {r["doc_id"]: r["labels"] for r in got}
    assert [(s["label"], s["start"], s["end"]) for r in got if r["doc_id"] == 7 for s in r["spans"]] == [("mit", 0, 5), ("mit", 5, 10)]
    assert {k: labels[k] for k in range(1, 6)} == {1: "mit", 2: "mit", 3: "bsd", 4: "bsd", 5: ""} and "mit" not in labels[6]


def test_no_window_that_verifies_is_dropped():
    rng = random.Random(4)
    cache = L.WordHashes()
    for _ in range(150):
        t = rng.randrange(len(L.TEMPLATES))
        want, own = L.words_of(L.TEMPLATES[t][1]), L.own_words()[t]
        words = [f"x{k}" for k in range(rng.randrange(30))]
        for w in want:
            words += [w] * (rng.random() < 0.75) + [rng.choice(want) if rng.random() < 0.3 else "y"] * (rng.random() < 0.4)
        words += ["z"] * rng.randrange(30)
        exact = []
        for i in range(len(words)):
            got = words[i : i + 2 * len(want)]
            blocks = SequenceMatcher(None, want, got, autojunk=False).get_matching_blocks()
            share = sum(m.size for m in blocks) / len(want)
            if share >= L.MATCHED and own <= {w for m in blocks for w in want[m.a : m.a + m.size]}:
                exact.append(share)
        found = [x for s in L.stretches(L._hashes(words, cache), L._hashes(want, cache)) for x in L.followed(want, own, words, *s)]
        assert max((x[2] for x in found), default=0) == max(exact, default=0)


def test_whole_licenses_in_a_file(docs):
    whole = {label: text for label, text in reversed(L.TEMPLATES) if len(L.words_of(text)) > 80}
    assert set(whole) == {"mit", "bsd", "isc", "zlib", "bsl-1.0", "unlicense"}
    rows = [(k, f"Copyright 2020 Somebody\n\n{text}\n\nint main() {{ return {k}; }}\n" + "other words " * 50) for k, text in enumerate(whole.values())]
    rows += [(50 + k, " ".join(w if i % 10 else "other" for i, w in enumerate(L.words_of(text)))) for k, text in enumerate(whole.values())]
    got = {r["doc_id"]: r for r in L.scan(docs(rows)).collect()}
    for k, label in enumerate(whole):
        assert label in got[k]["labels"].split(",") and got[k]["score"] == 1.0
        assert label in got[50 + k]["labels"].split(",") and 0.8 < got[50 + k]["score"] < 1
    assert got[list(whole).index("zlib")]["labels"] == "zlib" and got[list(whole).index("isc")]["labels"] == "isc"
