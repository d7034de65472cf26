import collections
import random

import regex

from carelattice.llm import decontamination as D
from carelattice.llm import queries

ITEM = "A farmer named Alice has 12 apples and 30 pears in 5 kg baskets. She gives Alice 12 of them. How many fruits does the old farmer keep in total?"
SWAPPED = "A farmer named Robert has 17 apples and 44 pears in 9 lb baskets. She gives Robert 17 of them. How many fruits does the old farmer keep in total?"
MIXED = "A farmer named Robert has 17 apples and 44 pears in 9 lb baskets. She gives Laura 21 of them. How many fruits does the old farmer keep in total?"
CLEAN = "An entirely different story about the sea, the wind and a long journey home over many weeks of calm weather and rain."


def found(spark, docs, rows, items):
    return {(r["doc_id"], r["item_id"]): r["kind"] for r in D.leaks(docs(rows), spark.createDataFrame(items, "item_id long, text string")).collect()}


def test_kinds(spark, docs, odd_rows):
    rows = [*odd_rows, (50, f"Before. {ITEM} After."), (51, f"Intro text here.\n{SWAPPED}"), (52, MIXED), (53, CLEAN), (54, ITEM.lower()), (55, f"{CLEAN} {ITEM} {ITEM}"), (55, ITEM)]
    got = found(spark, docs, rows, [(7, ITEM), (8, CLEAN), (9, "too short"), (10, None), (None, ITEM)])
    assert {k for k in got if k[0] < 54} == {(50, 7), (51, 7), (53, 8)}
    assert got[50, 7] == "verbatim" and got[51, 7] == "reparameterised"
    assert (55, 7) in got and (55, 8) in got


def test_stage_and_empty_tables(spark, docs):
    bench = spark.createDataFrame([(7, ITEM)], "item_id long, text string")
    source = docs([(1, ITEM), (2, CLEAN), (None, ITEM), (3, None)])
    kept = D.drop_leaks(source, bench)
    assert kept.columns == source.columns and sorted((r["doc_id"] for r in kept.collect()), key=str) == [2, 3, None]
    assert D.drop_leaks(source, bench.where("false")).count() == 4
    assert D.leaks(source.where("false"), bench).collect() == []


def test_shuffled_join_gives_the_same(spark, docs, monkeypatch):
    rows, items = [(50, ITEM), (51, SWAPPED), (53, CLEAN)], [(7, ITEM), (8, CLEAN)]
    broadcast = found(spark, docs, rows, items)
    monkeypatch.setattr(D, "BROADCAST_WINDOWS", 0)
    assert found(spark, docs, rows, items) == broadcast


NUMBERS = "3 + 4 = 7; 12 * 5 = 60; 81 / 9 = 9; 7 - 2 = 5; 6 * 6 = 36; what is 5 + 5?"


def test_plain_windows(spark, docs):
    names = "Then Alice, Robert, Laura, Peter, Maria, Simon, Helen, Oscar and Nina met Victor, Daniel, Thomas, Walter, Julia."
    short = "Define Gibbs entropy now"
    rows = [
        (54, ITEM.lower()), (55, ITEM.upper()), (60, f"Numbers. {NUMBERS} End."), (61, NUMBERS.replace("1", "2").replace("6", "8")), (62, f"So {names}"),
        (63, "One line: define gibbs ENTROPY now, please."), (64, "Define entropy now"), (65, "0 0 0 0 0 0 0 0"), (66, "Alice and Robert met Laura and Peter."),
    ]
    got = found(spark, docs, rows, [(7, ITEM), (10, NUMBERS), (11, names), (12, short), (13, "0 " * 60), (14, "")])
    assert got == {(i, k): "verbatim" for i, k in [(54, 7), (55, 7), (60, 10), (62, 11), (63, 12)]}


def test_slots_outside_the_windows_met_are_not_compared(spark, docs):
    item = "the old farmer named Alice keeps 12 apples in the small barn behind the house where nobody ever goes and Alice sold 12 of those"
    doc = "the old farmer named Robert keeps 17 apples in the small barn behind the house where nobody ever goes while Laura ate 21 pears"
    assert found(spark, docs, [(1, doc)], [(7, item)]) == {(1, 7): "reparameterised"}


def test_items_of_a_few_words_must_be_the_whole_document(spark, docs):
    rows = [(1, "The sea is calm, yes, and the wind too."), (2, "Yes."), (3, "yes, yes"), (4, "THE sea!"), (5, "Is it? Yes. The sea"), (6, "the sea is calm today"), (7, None), (8, "")]
    items = [(1, "yes"), (2, "the sea"), (3, "..."), (4, "The sea is calm today")]
    assert found(spark, docs, rows, items) == {(2, 1): "verbatim", (4, 2): "verbatim", (6, 4): "verbatim"}
    assert found(spark, docs, rows, items[:3]) == {(2, 1): "verbatim", (4, 2): "verbatim"}


def plain_tokens(text):
    raw = regex.findall(D.TOKEN, text or "")
    out = []
    for i, w in enumerate(raw):
        before, low = raw[i - 1] if i else None, w.lower()
        if w in ".!?:\n":
            continue
        if "0" <= w[0] <= "9":
            kind = D.NUMBER
        elif before is not None and "0" <= before[0] <= "9" and low in D.UNITS:
            kind = D.UNIT
        elif before is not None and before not in ".!?:\n" and low != w and w[0].lower() != w[0]:
            kind = D.NAME
        else:
            kind = low
        out.append((w, kind))
    return out


SLOTS = (D.NUMBER, D.UNIT, D.NAME)


def plain_leaks(rows, items):
    """{(doc_id, item): kind} by comparing every document with every item, window by window."""
    def views(t):
        kinds, low = [k for _, k in t], [w.lower() for w, _ in t]
        n = len(t) - D.WIDTH + 1
        typed = {i: tuple(kinds[i : i + D.WIDTH]) for i in range(n) if sum(k not in SLOTS for k in kinds[i : i + D.WIDTH]) >= D.LITERALS}
        plain = {i: tuple(low[i : i + D.WIDTH]) for i in range(n)}
        return typed, plain, low

    out = {}
    for item, item_text in items:
        its = plain_tokens(item_text)
        if not its:
            continue
        it_typed, it_plain, it_low = views(its)
        if len(its) < D.WIDTH:
            it_plain = {0: tuple(it_low)}
        for doc, text in rows:
            own = plain_tokens(text)
            typed, plain, low = views(own)
            if len(its) < D.LEAST:
                plain = {0: tuple(low)} if len(low) == len(its) else {}
            elif len(its) < D.WIDTH:
                plain = {i: tuple(low[i : i + len(its)]) for i in range(len(low) - len(its) + 1)}
            hits, places = collections.Counter(), collections.defaultdict(set)
            for a, w in it_typed.items():
                hits.update(p - a for p, v in typed.items() if v == w)
            for a, w in it_plain.items():
                for p, v in plain.items():
                    if v == w:
                        places[p - a].add(a)
            shifts = set(hits) | set(places)
            if not shifts:
                continue
            shift = max(shifts, key=lambda s: (hits[s], len(places[s]), -s))
            total = min(sum(hits.values()), len(it_typed))
            met = min(len(set().union(*places.values())), len({a + s for s, at in places.items() for a in at})) if places else 0
            enough = lambda k, n: n > 0 and (100 * k >= D.COVERED * n or k >= D.RUN)
            by_type, by_plain = enough(total, len(it_typed)), enough(met, len(it_plain))
            same = [0 <= i + shift < len(own) and own[i + shift][1] == k for i, (_, k) in enumerate(its)]
            windows = [i for i in range(len(its) - D.WIDTH + 1) if all(same[i : i + D.WIDTH]) and sum(k not in SLOTS for _, k in its[i : i + D.WIDTH]) >= D.LITERALS]
            inside = {i + k for i in windows for k in range(D.WIDTH)}
            pairs = [(k, w, own[i + shift][0]) for i, (w, k) in enumerate(its) if k in SLOTS and same[i] and i in inside]
            distinct = set(pairs)
            clash = max(len(distinct) - len({x[:2] for x in distinct}), len(distinct) - len({(x[0], x[2]) for x in distinct}))
            changed = sum(a != b for _, a, b in pairs)
            sound = by_type and (clash == 0 or (total >= len(it_typed) and 5 * clash <= len(pairs)) or changed == 0)
            if sound or by_plain:
                out[doc, item] = "verbatim" if not sound or changed == 0 or met >= len(it_plain) else "reparameterised"
    return out


def test_against_brute_force_on_the_tables(spark, docs):
    sf = "/root/testdata/sf0.001"
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    got = {(r["doc_id"], r["item_id"]): r["kind"] for r in queries.QUERIES["op3_decontamination"](spark, sf).collect()}
    assert got == plain_leaks(rows, items) and got


def test_against_brute_force_on_random_texts(spark, docs):
    rnd = random.Random(6)
    words = ["the", "farmer", "has", "apples", "and", "buys", "kg", "7", "12", "Alice", "Robert", "pears", "of", "them", ".", "He", "sells", "30", "old", "barn"]
    items = [(k, " ".join(rnd.choices(words, k=rnd.choice((1, 2, 3, 5, 7, 9, 14, 30))))) for k in range(30)]
    rows = []
    for k in range(120):
        base = rnd.choice(items)[1].split()
        changed = [rnd.choice(words) if rnd.random() < 0.08 else {"Alice": "Laura", "12": "44"}.get(w, w) if k % 2 else w for w in base]
        rows.append((k, " ".join(rnd.choices(words, k=rnd.randint(0, 12)) * (k % 3 > 0) + changed + rnd.choices(words, k=rnd.randint(0, 9)) * (k % 5 > 0))))
    got = found(spark, docs, rows, items)
    assert got == plain_leaks(rows, items) and len(set(got.values())) == 2
