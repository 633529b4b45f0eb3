import hashlib
import re

from candlewick.llm import disclosure

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    t = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
    return sum(x - 9 if x > 9 else x for x in t) % 10 == 0


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind != "ip" or all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 16 <= len(d) <= 19 and luhn(d), "phone": 8 <= len(d) <= 15}[kind]
            if ok:
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


CASES = ["a@b.c+x@y.zz a.b@c-d.e.f.", "@a.b a@ a@b a@b. a@.b é@b.c", "1.2.3.4.5.6.7.8 256.1.1.1 0255.01.1.1 1.2.3", "x1.1.1.1y 👍9.9.9.9",
         "4111111111111111 4111-1111 1111 1111 4111 1111 1111 1112 1 2", "+1 (499) 555-6503 +1234567 ++12345678. +1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6",
         "漢字 a@b.co 漢字 +49 30 123456-7", "a.b@c.d@e.f", "1" * 3000, "a" * 3000 + "@", "1.1" * 200, "@" * 50, "a@b" * 100]


def test_base_spans(spark, sf_dir, frame, texts):
    every = [*texts, *CASES]
    got = disclosure.detect(frame(every), keep=["word"]).collect()
    for r in got:
        spans = [f"{k}:{s.start}:{s.end}" for k in disclosure.KINDS for s in r.base[k]]
        assert spans == base(every[r.word]), every[r.word]


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    out = disclosure.op7_disclosure(spark, sf_dir).collect()
    assert len(out) == len(docs)
    for r in out:
        want = base(docs[r.doc_id])
        assert r.base_sha256 == hashlib.sha256(",".join(want).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(w.startswith(k) for w in want) for k in PATTERNS]
        assert (r.spans.split(",") if r.spans else [])[:len(want)] == want


def corpus():
    # "Quixworth" stands near one address in 4 texts and nowhere else; "often"
    # near it too, but mostly elsewhere; "rare" only in copies of one text.
    t = [f"Note {i} by Quixworth often, q.w@mail.org here {i}." for i in range(4)]
    t += ["rare zebra x@y.org end"] * 5
    t += [f"they often walk {i} miles" for i in range(200)]
    return t


def test_terms(spark, frame):
    rows = {r.word: r for r in disclosure.detect(frame(corpus())).collect()}
    for i, text in enumerate(corpus()):
        words = [text[s.start:s.end] for s in rows[i].terms]
        assert words == (["Note", "Quixworth", "here"] if i < 4 else [])
        assert all(s.disclosure > 0.99 for s in rows[i].terms)


def test_terms_match_counts(spark, frame):
    """Thresholds follow PMI / IC computed by hand."""
    from math import log2
    t = [f"doc {i} Kappa z@z.io" for i in range(4)] + [f"Kappa alone {i}" for i in range(3)] + [f"filler {i}" for i in range(93)]
    rows = {r.word: r for r in disclosure.detect(frame(t)).collect()}
    found = {t[0][s.start:s.end]: s.disclosure for s in rows[0].terms}
    want = log2(100 * 4 / (4 * 7)) / log2(100 / 4)
    assert abs(found["Kappa"] - want) < 1e-9 and disclosure.GENERALISE_AT <= want < disclosure.REMOVE_AT


def test_sanitise(spark, frame, texts):
    d = frame([*corpus(), None, "", "clean text"])
    out = {r.word: r for r in disclosure.sanitise(d).collect()}
    assert out[0].text == " 0 by  often, <EMAIL>  0."
    assert out[4].text == "rare zebra <EMAIL> end"
    n = len(corpus())
    assert [out[i].text for i in (n, n + 1, n + 2)] == [None, "", "clean text"]
    assert disclosure.sanitise(d).columns == d.columns
    assert disclosure.sanitise(d.limit(0)).collect() == []


def test_entities_seen_once_or_twice(spark):
    """Judged by how rare the term is; copies of one text are evidence once."""
    few = ["Zorblat wrote to once@x.org yesterday", "Quillfeather wrote twice@x.org, yesterday 1",
           "yesterday 2 twice@x.org Quillfeather wrote"] + ["copied@x.org from Mimblewick"] * 150
    rest = spark.range(20000).selectExpr("concat('they wrote ', id, ' yesterday') AS text")
    d = rest.union(spark.createDataFrame([(t,) for t in few], "text string"))
    out = [r for r in disclosure.detect(d).collect() if not r.text.startswith("they")]
    words = {r.text: [(r.text[s.start:s.end], s.sure >= disclosure.REMOVE_AT) for s in r.terms] for r in out}
    assert len(out) == len(few)
    assert [words[t] for t in few[:4]] == [[("Zorblat", True)], [("Quillfeather", True)], [("Quillfeather", True)], []]


def test_terms_far_from_the_span(spark, frame):
    """Counted by document and sanitised at every place, also far from the span."""
    gap = "they often walk along " * 20
    t = [f"Quixworth {i} {gap} Brontide {gap} Quixworth, q.w@mail.org {gap} QUIXWORTH" for i in range(4)]
    t += [f"they often walk along {i} miles" for i in range(200)]
    rows = {r.word: r for r in disclosure.detect(frame(t)).collect()}
    for i, text in enumerate(t):
        words = [text[s.start:s.end] for s in rows[i].terms]
        assert words == (["Quixworth", "Brontide", "Quixworth", "QUIXWORTH"] if i < 4 else [])
    out = {r.word: r.text for r in disclosure.sanitise(frame(t)).collect()}
    assert all("quixworth" not in out[i].lower() and "Brontide" not in out[i] for i in range(4)) and out[4] == t[4]


def test_no_python_in_the_plan(spark, sf_dir):
    plan = disclosure.op7_disclosure(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
