from __future__ import annotations

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from reviewmill.llm import pii as P
from tests.llm.data import DOC_SCHEMA, documents, prose


def luhn(digits):
    twice = [int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))]
    return sum(twice) % 10 == 0


def plain_spans(text):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


FIXED = {
    0: None, 1: "", 2: "a@b.c", 3: "a@b.c@d.e", 4: "a@b..c@d.e", 5: "x@y.z_w@q.r", 6: "..@a.b.", 7: "1.2.3.4.5.6.7.8", 8: "256.1.1.1 000255.1.1.1",
    9: "4111 1111-1111 1111", 10: "4111  1111 1111 1111", 11: "-4111111111111111-", 12: "+1 (555) 123-4567.", 13: "+1+12345678((", 14: "é😀a@b.co 4111111111111111",
    15: "4111111111111112", 16: "+123456789012345678", 17: "1234.1.1.1.1",
}


def test_base_spans_equal_plain_patterns(spark, stage):
    draw = random.Random(8)
    bits = ["a", "b.", "@", "..", "1", "23.", "4", "-", " ", "_", "+", "(5)", "255.", "4111111111111111", "é", "😀", "@x.y", "\n"]
    texts = FIXED | {100 + i: "".join(draw.choice(bits) for _ in range(draw.randint(1, 40))) for i in range(1500)}
    docs = documents(spark, texts).withColumn("email", F.lit("x")).withColumn("spans", F.lit(1)).withColumn("copy", F.lit(2))
    got = {r["doc_id"]: r for r in P.personal_spans(docs, stage, least=10**6).collect()}
    assert len(got) == len(texts)
    for i, text in texts.items():
        spans = plain_spans(text or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        row = got[i]
        assert row["spans"] == listed
        assert row["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
        assert [row[f"n_{k}"] for k in P.KINDS] == [sum(s[0] == k for s in spans) for k in P.KINDS]


def test_long_texts_take_linear_time(spark, stage):
    texts = {1: "9" * 100_000, 2: "x" * 200_000, 3: "a@" + "b.c" * 30_000, 4: "1 " * 50_000 + "a@b.c", 5: "a.b" * 50_000, 6: "@" * 100_000, 7: "+1" + "(" * 100_000}
    got = {r["doc_id"]: r for r in P.personal_spans(documents(spark, texts), stage).collect()}
    assert {i: got[i]["spans"] for i in texts} == {i: ",".join(f"{k}:{a}:{b}" for k, a, b in plain_spans(texts[i])) for i in (1, 4, 6, 7)} | {
        2: "", 3: "email:0:90002", 5: ""
    }


def holders():
    """Three texts hold one address next to a name that occurs nowhere else; others hold neither."""
    texts = {i: " ".join(prose(i, 30)) + f" Zanzibarov writes from zan@mail.org. {i}" for i in range(3)}
    texts |= {10 + i: " ".join(prose(50 + i, 30)) for i in range(60)}
    texts |= {100 + i: "copy of one text alone@mail.org Quixotic" for i in range(5)}
    return texts


def test_disclosing_terms(spark, stage):
    got = {r["doc_id"]: r for r in P.personal_spans(documents(spark, holders()), stage).collect()}
    for i in range(3):
        text = holders()[i]
        name = text.index("Zanzibarov")
        spans = got[i]["spans"].split(",")
        assert spans[0].startswith("email:") and f"term:{name}:{name + 10}" in spans
        assert got[i]["n_terms"] == len(spans) - 1 <= 3
    assert all(got[i]["n_terms"] == 0 for i in got if i >= 10)  # other texts, and copies of one text


def test_sanitise(spark, stage):
    texts = holders() | {200: None, 201: "call +1 (555) 123-4567 or a@b.co, 10.0.0.1, 4111111111111111 ok", 202: "plain 123"}
    docs = documents(spark, texts).withColumn("terms", F.lit("mine")).withColumn("_x", F.lit(0))
    docs = docs.unionByName(docs.filter("doc_id = 201")).unionByName(docs.filter("doc_id = 201").withColumn("doc_id", F.lit(None).cast("bigint")))
    out = P.sanitise(docs, stage)
    assert out.columns == docs.columns
    rows = out.collect()
    assert len(rows) == docs.count()
    by_id = {r["doc_id"]: r for r in rows}
    assert by_id[201]["text"] == by_id[None]["text"] == "call <phone> or <email>, <ip>, <card> ok"
    assert by_id[202]["text"] == "plain 123" and by_id[200]["text"] is None and by_id[200]["n_chars"] is None
    assert by_id[201]["n_chars"] == len(by_id[201]["text"])
    for i in range(3):
        assert "zan@mail.org" not in by_id[i]["text"] and "Zanzibarov" not in by_id[i]["text"] and "<name>" in by_id[i]["text"]
    assert all(by_id[i]["text"] == texts[i] for i in range(10, 70))


def test_overlapping_spans_are_masked_once(spark):
    row = spark.createDataFrame([("+1 111.2.3.45 x",)], "t string")
    spans = F.concat(*[P.base_spans(F.col("t"), k) for k in P.KINDS])
    out = row.select(P.mask(F.col("t"), spans).alias("m")).first()["m"]
    assert not re.search("[0-9]{2}", out) and out.endswith(" x")


def test_empty_table(spark, stage):
    empty = spark.createDataFrame([], DOC_SCHEMA)
    assert P.personal_spans(empty, stage).count() == 0
    assert P.sanitise(empty, stage).count() == 0


def test_plan_is_native(spark, stage):
    plan = P.personal_spans(documents(spark, {1: "a"}), stage)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_entities_that_stand_in_one_document_are_estimated(spark, stage):
    """Every address is held by one document; the name beside them stands nowhere else."""
    texts = {i: " ".join(prose(i, 30)) + f" ask Zanzibarov at box{i}@mail{i % 2}.org now" for i in range(6)}
    texts |= {20 + i: " ".join(prose(20 + i, 30)) + f" ask Quixotic at +49 30 55500{i} now" for i in range(4)}
    texts |= {50 + i: " ".join(prose(50 + i, 30)) + " ask at now" for i in range(90)}
    got = {r["doc_id"]: r for r in P.personal_spans(documents(spark, texts), stage).collect()}
    for i in (*range(6), *range(20, 24)):
        name = "Zanzibarov" if i < 20 else "Quixotic"
        at = texts[i].index(name)
        assert got[i]["spans"].split(",")[1:] == [f"term:{at}:{at + len(name)}"]
    assert all(got[i]["n_terms"] == 0 for i in got if i >= 50)


def test_names_inside_the_address_are_marked(spark, stage):
    texts = {i: " ".join(prose(i, 30)) + f" Zan Zoltan of Quorp sent mail {i} from zan.zoltan@quorp.com" for i in range(4)}
    texts |= {20 + i: " ".join(prose(20 + i, 30)) + f" of sent mail {i} from" for i in range(60)}
    got = {r["doc_id"]: r for r in P.personal_spans(documents(spark, texts), stage).collect()}
    for i in range(4):
        ends = [(texts[i].index(w), texts[i].index(w) + len(w)) for w in ("Zan", "Zoltan", "Quorp")]
        assert got[i]["spans"].split(",")[1:] == [f"term:{a}:{b}" for a, b in ends]
    assert all(got[i]["n_terms"] == 0 for i in got if i >= 20)


def test_runs_of_marks_take_linear_time(spark):
    marks = "=" * 100_000
    frame = spark.createDataFrame([(f"a{marks}b", marks, f"c {marks} {marks}- d", f"({marks}e")], "a string, b string, c string, d string")
    began = time.perf_counter()
    row = frame.select(
        *[P.plain_words(F.col(c)).alias(c) for c in "abcd"], P._bare(F.col("a")).alias("bare"), P._bare(F.concat("a", F.lit(marks))).alias("tail")
    ).first()
    assert time.perf_counter() - began < 10
    assert (row["a"], row["b"], row["c"], row["d"]) == ([f"a{marks}b"], [], ["c", "d"], ["e"])
    assert row["bare"] == row["tail"] == f"a{marks}b"


def test_a_copy_and_a_stranger_prove_nothing(spark, stage):
    texts = {i: f"one{i} two{i} three{i} four{i} five{i} six{i}" for i in range(30)}
    texts[0] = texts[1] = "we met Ofenwhen by the river at dawn, see ann@mail.org"
    texts[2] = "quite another letter names Ofenwhen too and gives bob@mail.org instead"
    docs = documents(spark, texts)
    assert not any(r["n_terms"] for r in P.personal_spans(docs, stage).collect())
    third = documents(spark, texts | {3: "a third writer heard that Ofenwhen lives there, cy@mail.org"})
    assert {r["doc_id"] for r in P.personal_spans(third, stage).collect() if r["n_terms"]} == {0, 1, 2, 3}
