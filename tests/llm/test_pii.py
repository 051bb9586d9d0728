import random
import re

import pytest
from pyspark.sql import functions as F

from linefold.llm import pii

from .conftest import messy_rows

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (2 if i % 2 else 1)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def confirmed(kind: str, span: str) -> bool:
    digits = re.sub("[^0-9]", "", span)
    if kind == "ip":
        return all(int(x) <= 255 for x in span.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def brute(text: str | None) -> str:
    found = []
    for number, (kind, pattern) in enumerate(BASE.items()):
        found += [(m.start(), number, kind, m.end()) for m in re.finditer(pattern, text or "") if confirmed(kind, m[0])]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))


def base_spans(docs):
    base = F.filter("pii", lambda s: s["kind"] < len(pii.BASE))
    return [r[0] for r in pii.find(docs).select(pii.joined(base)).collect()]


def every_span(spark, texts):
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    return [r[0].split(",") if r[0] else [] for r in pii.find(docs).select(pii.joined(F.col("pii"))).collect()]


def test_base_spans_of_random_texts(spark):
    rng = random.Random(7)
    pieces = ["a.b@c.de", "x@y", "@", "_e@f.g", "1.2.3.4", "300.1.2.3", "255.0.00255.1", "1.2.3", "4111 1111 1111 1111", "4111-1111 1111-1112",
              "+1 (743) 555-3824", "+49", "+", " ", "  ", "-", ".", "é", "\U0001f600", "0", "79927398713", "12345678901234567890", "\n", "()", "a"]
    texts = ["".join(rng.choice(pieces) for _ in range(rng.randint(0, 25))) for _ in range(600)]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert base_spans(docs) == [brute(t) for t in texts]


def test_messy_and_empty_tables(messy, nothing, small):
    assert sorted(base_spans(messy)) == sorted(brute(r[1]) for r in messy_rows())
    assert pii.find(nothing).count() == 0
    assert sorted(base_spans(small)) == sorted(brute(r["text"]) for r in small.collect())


@pytest.mark.parametrize("text", ["1" * 100_000, "a" * 200_000, "1 " * 60_000, "1." * 60_000, "a.b@c.de," * 3_000, "+1 " * 30_000, "a" * 50_000 + "@" + "b." * 50_000 + "c"])
def test_long_runs_take_no_deep_stack_nor_square_time(spark, text):
    docs = spark.createDataFrame([(text,)], "text string")
    assert base_spans(docs) == [brute(text)]


def test_added_kinds_need_a_checksum_or_context(spark):
    texts = [
        "iban DE89 3704 0044 0532 0130 00 ok",
        "iban DE88 3704 0044 0532 0130 00 ok",
        "my ssn is 123-45-6789",
        "part no 123-45-6789",
        "please call (743) 555-3824 now",
        "lot (743) 555-3824 now",
        "old card 4222222222222",
        "code 4222222222222",
    ]
    got = every_span(spark, texts)
    assert got == [["iban:5:32"], [], ["id_number:10:21"], [], ["local_phone:12:26"], [], ["short_card:9:22"], []]


def test_context_raises_the_score(spark):
    docs = spark.createDataFrame([("ping host 8.8.8.8",), ("value 8.8.8.8",)], "text string").coalesce(1)
    with_word, without = [r["pii"][0]["score"] for r in pii.find(docs).collect()]
    assert with_word > without >= pii.THRESHOLD


def test_redaction(spark):
    docs = spark.createDataFrame([("mail a.b@c.de or 8.8.8.8!",), (None,)], "text string").coalesce(1)
    assert [r[0] for r in pii.find(docs).select(pii.redact(F.coalesce("text", F.lit("")), F.col("pii"))).collect()] == ["mail [email] or [ip]!", ""]


def test_fully_separated_cards(spark):
    texts = [sep.join("4111111111111111") for sep in " -"] + ["card " + sep.join("4222222222222") for sep in " -"]
    texts += [sep.join("4111111111111112") for sep in " -"]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    assert base_spans(docs) == [brute(t) for t in texts]
    assert every_span(spark, texts) == [["card:0:31"]] * 2 + [["short_card:5:30"]] * 2 + [[]] * 2


def test_account_numbers_before_other_words(spark):
    tails = ["", " BIC COBADEFFXXX", " BIC: COBADEFFXXX", " Amount 5", " The rest", " 2024 ok", " I will", ", x", " 1234 5678 9012 3456 7890"]
    texts = [f"IBAN {iban}{tail}" for iban in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00") for tail in tails]
    got = every_span(spark, texts)
    assert [[s for s in spans if s.startswith("iban")] for spans in got] == [["iban:5:27"]] * len(tails) + [["iban:5:32"]] * len(tails)
    texts = [
        "AB12 DE89370400440532013000 GB82WEST12345698765432 NO9386011117947",
        "DE88370400440532013000 BIC",
        "DE89370400440532013000x",
        "DE893704004405320130001",
        "\u00e9\U0001f600 GB82 WEST 1234 5698 7654 32 AND",
        "Ref XX" + f"{98 - int('370400440532013000' + '333300') % 97:02d}" + "370400440532013000 NEXT",
    ]
    got = [[s for s in spans if s.startswith("iban")] for spans in every_span(spark, texts)]
    assert got == [["iban:5:27", "iban:28:50", "iban:51:66"], [], [], [], ["iban:3:30"], ["iban:4:26"]]
