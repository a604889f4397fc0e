import hashlib
import math
import random
import re
from collections import defaultdict

import pytest
import regex

from commitlake.llm import pii

CONTRACT = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def ok(kind, value):
    digits = re.sub("[^0-9]", "", value)
    return {"email": True, "ip": all(int(p) <= 255 for p in value.split(".")) if kind == "ip" else True,
            "card": 14 <= len(digits) <= 19 and luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]


def brute(text):
    found = []
    for i, (kind, pattern) in enumerate(CONTRACT.items()):
        found += [(m.start(), i, m.end(), kind) for m in re.finditer(pattern, text or "") if ok(kind, m.group())]
    return sorted(found)


def odd_texts():
    rng = random.Random(11)
    pieces = ["a@b.c", "_d@e.f", "x.y+z@mail.example.com", "1.2.3.4", ".5.6.7.8", "0000255.1.1.1", "256.1.1.1", "4111 1111 1111 1111",
              "4111-1111-1111-1112", "+49 (30) 1234567", "+1", "+12345678901", "2390409500648960", "@", ".", "-", " ", "  ", "é", "𝄞", "7",
              "99", "word", "中", "+", "(", ")", "\n", "55@mail9.example.com."]
    return ["".join(rng.choice(pieces) for _ in range(rng.randrange(1, 25))) for _ in range(800)] + [
        "1 " * 20000, "9" * 20000, "a" * 20000 + "@b", "+1" + " 2" * 20000, "1." * 20000, "a@b" + ".c" * 20000, "12 345. " * 20000, "1.2.3.4 x@y.z " * 5000, "", None]


def test_base_spans_equal_the_contract(spark):
    texts = odd_texts()
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    for row in pii.pii_table(docs).collect():
        want = brute(texts[row.doc_id])
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [sum(w[1] == i for w in want) for i in range(4)]
        joined = ",".join(f"{w[3]}:{w[0]}:{w[2]}" for w in want)
        assert row.base_sha256 == hashlib.sha256(joined.encode()).hexdigest(), texts[row.doc_id]
        assert set(joined.split(",")) - {""} <= set(row.spans.split(","))


@pytest.fixture(scope="module")
def told(spark):
    """anna@x.org is met with 'zebra' in many surroundings and nowhere else; 'people' is everywhere."""
    rows = [(i, f"note {chr(97 + i)}aa zebra people wrote anna@x.org about {chr(97 + i)}bb", "s", 0) for i in range(8)]
    rows += [(20 + i, f"other people talk {i} about things and zoo number {i}", "s", 0) for i in range(60)]
    rows += [(90 + i, "copied quokka people bob@y.org here", "s", 0) for i in range(5)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")


Z2 = 1.6448536269514722 ** 2


def likely(met, of):
    return (met + Z2 / 2 - math.sqrt(Z2) * math.sqrt(met * (of - met) / of + Z2 / 4)) / (of + Z2)


def brute_spans(texts):
    """All spans of each text: every entity with every word of the corpus, by definition."""
    clean, entities = {}, {}
    for t in {t for t in texts if t is not None}:
        base = brute(t)
        chars = list(t)
        for start, _, end, _ in base:
            chars[start:end] = " " * (end - start)
        clean[t] = "".join(chars)
        entities[t] = {t[s:e].lower() for s, _, e, _ in base}
    words = {t: {m.group().lower() for m in regex.finditer(pii.TERM, c)} for t, c in clean.items()}
    with_term, with_entity = defaultdict(set), defaultdict(set)
    for t in clean:
        for w in words[t]:
            with_term[w].add(t)
        for e in entities[t]:
            with_entity[e].add(t)
    hidden = {}
    for e, own in with_entity.items():
        for w in {w for t in own for w in words[t]}:
            left = -math.log2(likely(len(own & with_term[w]), len(with_term[w])))
            if left <= pii.GENERALISE and math.log2(len(clean) / len(own)) - left >= pii.GAIN:
                hidden[w] = min(hidden.get(w, 9), left)
    out = {}
    for t in clean:
        found = [(s, i, e, kind) for s, i, e, kind in brute(t)]
        found += [(m.start(), 4, m.end(), "term") for m in regex.finditer(pii.TERM, clean[t]) if m.group().lower() in hidden]
        out[t] = ",".join(f"{k}:{s}:{e}" for s, _, e, k in sorted(found))
    return out, hidden


def spans_of(frame):
    return sorted(((r.doc_id is None, r.doc_id or 0), r.spans) for r in pii.pii_table(frame).collect())


def check_all_spans(frame):
    rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
    want, hidden = brute_spans([t for _, t in rows])
    assert spans_of(frame) == sorted(((d is None, d or 0), want.get(t, "")) for d, t in rows)
    return hidden


def test_terms_that_disclose_an_entity(told):
    rows = {r.id: r for r in pii.find_personal_data(told).collect()}
    texts = {r.doc_id: r.text for r in told.collect()}
    for i in range(8):
        values = {texts[i][s.start:s.end] for s in rows[i].terms}
        assert "zebra" in values and "people" not in values
    assert all(rows[20 + i].terms is None and rows[20 + i].base is None for i in range(60))
    assert all(rows[90 + i].terms is None for i in range(5)), "copies of one text are one meeting"


def test_all_spans_by_brute_force(told):
    assert "zebra" in check_all_spans(told)


def test_all_spans_of_edge_tables_by_brute_force(spark, edge, clashing):
    check_all_spans(edge)
    check_all_spans(clashing)
    hostile = [(i, t) for i, t in enumerate(odd_texts()) if t is None or len(t) < 5000]
    hostile += [(i, f"{t} okapi éland q@r.st okapi") for i, t in hostile[:30] if t]
    hidden = check_all_spans(spark.createDataFrame(hostile * 2, "doc_id long, text string").repartition(3))
    assert {"okapi", "éland"} <= set(hidden)


def corpus_with_planted_terms(n=1500):
    """Documents of common and rare words; forty people have an address and an odd name that stand together in some texts."""
    rng = random.Random(2)
    common = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400)]
    letters = lambda i: "".join(chr(97 + int(d)) for d in f"{i:05}")
    rows, planted = [], set()
    for i in range(n):
        text = rng.choices(common, [1 / (k + 1) for k in range(400)], k=60) + [f"rare{letters(i)}x{k}y" for k in range(3)]
        rows.append((i, text))
    for p in range(40):
        met = rng.randrange(1, 12)
        for i in rng.sample(range(n), met):
            rows[i][1].extend([f"name{letters(p)}", f"p{p}@mail.org"])
        if met >= 3:
            planted.add(f"name{letters(p)}")
    for i, text in rows:
        rng.shuffle(text)
    return [(i, " ".join(t)) for i, t in rows], planted


def test_precision_on_planted_terms(spark):
    rows, planted = corpus_with_planted_terms()
    hidden = set(check_all_spans(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)))
    assert planted <= hidden, "names that three or more texts tie to their address are found"
    assert len(hidden & planted) >= 0.95 * len(hidden), "and hardly an ordinary word with them"


@pytest.mark.parametrize("copies", [1, 20])
def test_copies_lose_the_same_terms_as_one(spark, copies):
    rows, _ = corpus_with_planted_terms(600)
    once = dict(spans_of(spark.createDataFrame(rows, "doc_id long, text string")))
    touched = [r for r in rows if "term" in once[(False, r[0])]][:3]
    more = rows + [(10_000 + 100 * k + i, t) for i in range(copies) for k, (_, t) in enumerate(touched)]
    again = dict(spans_of(spark.createDataFrame(more, "doc_id long, text string")))
    assert touched and all(again[k] == v for k, v in once.items())
    assert all(again[(False, 10_000 + 100 * k + i)] == once[(False, d)] for i in range(copies) for k, (d, _) in enumerate(touched))


def test_the_level_does_not_loosen_with_the_corpus(spark):
    rows = [(0, "quagga people wrote to eve@x.org today")] + [(i, f"people wrote about things today {i}") for i in range(1, 4000)]
    for n in (50, 4000):
        found = pii.find_personal_data(spark.createDataFrame(rows[:n], "doc_id long, text string")).where("id = 0").first()
        assert found.terms is None, "one meeting is weak evidence, however many other texts there are"


@pytest.mark.parametrize("stretch", [1, 7])
def test_places_of_a_long_text(spark, monkeypatch, stretch):
    monkeypatch.setattr(pii, "STRETCH", stretch)
    rng = random.Random(1)
    texts = [" ".join(rng.choices(["okapi", "Zebra", "é", "ünder", "a-b'c", "𝄞𝄞𝄞x", "12ab"], k=n)) for n in (0, 1, 6, 7, 8, 50, 3000)]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in frame.select("text", pii.places(frame.text, lambda w: w.isin("okapi", "a-b'c", "ünder")).alias("p")).collect():
        assert [tuple(x) for x in r.p] == [(m.start(), m.end(), m.group()) for m in regex.finditer(pii.TERM, r.text)
                                           if m.group().lower() in ("okapi", "a-b'c", "ünder")]


def test_sanitised_texts(told):
    out = {r.doc_id: r for r in pii.sanitise_documents(told).collect()}
    before = {r.doc_id: r.text for r in told.collect()}
    assert "anna@x.org" not in out[0].text and "[EMAIL]" in out[0].text and "zebra" not in out[0].text
    assert out[0].n_chars == len(out[0].text)
    assert all(out[i].text == before[i] and out[i].n_chars == 0 for i in range(20, 80))


def test_edges(edge, clashing, nothing):
    assert pii.pii_table(edge).count() == edge.count()
    assert pii.pii_table(nothing).count() == 0
    out = pii.sanitise_documents(clashing)
    assert out.columns == clashing.columns and out.exceptAll(clashing).count() == 0 and out.count() == clashing.count()


def test_sanitising_a_repeated_row(spark):
    docs = spark.createDataFrame([(1, "mail a@b.cd", 0)] * 3 + [(None, "mail a@b.cd", 0)], "doc_id long, text string, n_chars long")
    assert [r.text for r in pii.sanitise_documents(docs).collect()] == ["mail [EMAIL]"] * 4


def test_native(told):
    plan = pii.pii_table(told)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_disclosing_terms_far_from_the_entity_and_in_other_documents(spark):
    filler = "people wrote about things today " * 5
    rows = [(i, f"okapi {filler}{i} anna@x.org") for i in range(8)] + [(8, f"an OKAPI, {filler}"), (9, "okapi")]
    rows += [(i, f"{filler}{i}") for i in range(10, 400)]
    out = {r.doc_id: r.text for r in pii.sanitise_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all("okapi" not in text.lower() for text in out.values())
    assert out[8] == f"an [TERM], {filler}" and out[9] == "[TERM]" and all(out[i] == rows[i][1] for i in range(10, 400))
