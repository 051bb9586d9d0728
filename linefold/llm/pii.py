"""Personal data: patterns propose spans, checksums confirm them, context words adjust the score.

Kinds, in their order: ``email``, ``ip`` (parts up to 255), ``card`` (14 to 19
digits that pass Luhn), ``phone`` (10 to 15 digits after a plus) are the base
kinds and always kept. The method adds ``iban`` (mod-97 at its country's length), ``short_card`` (12 or
13 digits that pass Luhn, next to a card word), ``id_number`` (ddd-dd-dddd next to
an identity word) and ``local_phone`` (ten grouped digits next to a phone word).

A span's score starts at its kind's prior; a context word of the kind within
``CONTEXT`` characters before or after adds to it. Spans below ``THRESHOLD`` go.
Matches of a kind are leftmost and do not overlap; spans of different kinds may.

Everything is row-local and native: one pass finds the matches and one splits
the text around them, and the lengths of both give the positions. Patterns take
their runs possessively and start only where a run starts, so long runs cost
linear time and constant stack.

Defined results: a null or empty text has no spans. Positions are code points,
the end exclusive. Any row is its own; repeated rows give repeated results.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linefold.llm.common import let, text_of

CONTEXT = 40
THRESHOLD = 0.5
BOOST = 0.35


@dataclass(frozen=True)
class Kind:
    """A kind of span: what proposes it, what must be in a text for it, its prior and its context words."""

    name: str
    pattern: str
    needs: str
    prior: float
    context: str


_DIGIT_PART = "0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
#: A run of digits with single blanks or hyphens between them starts and ends here.
_RUN_START, _RUN_END = r"(?<![0-9])(?<![0-9][\x20-])", r"(?![\x20-]?[0-9])"

KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        "@",
        0.9,
        r"e-?mail|contact|write to|correo|courriel|kontakt",
    ),
    Kind(
        "ip",
        r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        ".",
        0.6,
        r"\bip\b|address|server|host|ping|adresse|servidor",
    ),
    Kind(
        "card",
        _RUN_START + r"[0-9](?:[\x20-]?[0-9]){13,18}+" + _RUN_END,
        "",
        0.8,
        r"card|visa|mastercard|credit|debit|tarjeta|karte|carte",
    ),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", "+", 0.7, r"phone|call|tel\b|mobile|fax|telefon|teléfono|téléphone"),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?=(?:\x20?[A-Z0-9]){11})",
        "",
        0.85,
        r"iban|bank|account|konto|compte|cuenta",
    ),
    Kind(
        "short_card",
        _RUN_START + r"[0-9](?:[\x20-]?[0-9]){11,12}+" + _RUN_END,
        "",
        0.25,
        r"card|visa|maestro|credit|debit|tarjeta|karte|carte",
    ),
    Kind(
        "id_number",
        r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
        "-",
        0.25,
        r"\bssn\b|social security|tax id|national id|passport",
    ),
    Kind(
        "local_phone",
        r"(?<![0-9+()-])(?<!\+[0-9]{1,3}[\x20-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9-])",
        "",
        0.25,
        r"phone|call|tel\b|mobile|fax|telefon|teléfono|téléphone",
    ),
)
#: Length of an account number by its country.
IBAN_LENGTHS = {
    country: int(n)
    for n, countries in (
        part.split(":")
        for part in (
            "15:NO 16:BE 18:DK,FI,FK,FO,GL,NL,SD 19:MK,SI 20:AT,BA,EE,KZ,LT,LU,MN,XK 21:CH,HR,LI,LV "
            "22:BG,BH,CR,DE,GB,GE,IE,ME,RS,VA 23:AE,GI,IL,IQ,OM,SO,TL 24:AD,CZ,ES,MD,PK,RO,SA,SE,SK,TN,VG 25:LY,PT,ST "
            "26:IS,TR 27:BI,DJ,FR,GR,IT,MC,MR,SM 28:AL,AZ,BY,CY,DO,GT,HN,HU,LB,NI,PL,SV 29:BR,EG,PS,QA,UA 30:JO,KW,MU,YE "
            "31:MT,SC 32:LC 33:RU"
        ).split()
    )
    for country in countries.split(",")
}
#: Most characters of an account number: 34 with a blank between any two.
_IBAN_SPAN = 67
BASE = ("email", "ip", "card", "phone")
SPAN = "struct<start:int,kind:int,end:int,score:double>"


def _digits(span: Column) -> Column:
    return F.regexp_replace(span, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether at most 20 digits pass Luhn: every second one from the right counts as the digit sum of its double."""
    d = F.lpad(digits, 20, "0")
    doubled = F.translate(d, "0123456789", "0246813579")
    terms = [F.substring(d if k % 2 == 0 else doubled, k, 1).cast("int") for k in range(1, 21)]
    return sum(terms[1:], terms[0]) % 10 == 0


def mod97(span: Column) -> Column:
    """Whether an account number passes mod-97: the first four characters last, letters as 10 to 35."""
    plain = F.regexp_replace(span, r"\x20", "")
    turned = F.concat(F.substring(plain, 5, 40), F.substring(plain, 1, 4))
    number = F.array_join(
        F.transform(
            F.regexp_extract_all(turned, F.lit("."), F.lit(0)),
            lambda c: F.when(c.between("0", "9"), c).otherwise((F.ascii(c) - 55).cast("string")),
        ),
        "",
    )
    pieces = F.regexp_extract_all(number, F.lit("[0-9]{1,16}"), F.lit(0))
    rest = F.aggregate(pieces, F.lit(0).cast("long"), lambda r, p: F.concat(r.cast("string"), p).cast("long") % 97)
    return rest == 1


def _account(ahead: Column) -> Column:
    """The account number at the start of a text: the groups up to its country's length that pass mod-97.

    For a country without a known length, the most groups of 15 to 34 characters that pass; null if none do.
    """
    groups = F.split(F.regexp_extract(ahead, r"^[A-Z0-9]++(?![a-z])(?:\x20[A-Z0-9]++(?![a-z]))*+", 0), r"\x20")
    known = F.create_map(*[F.lit(x) for pair in IBAN_LENGTHS.items() for x in pair])

    def passing(g: Column) -> Column:
        prefixes = F.transform(g, lambda _, i: F.array_join(F.slice(g, 1, i + 1), " "))
        n = lambda p: F.length(F.replace(p, F.lit(" "), F.lit("")))
        fits = lambda p: n(p).between(15, 34) & (n(p) == F.coalesce(F.try_element_at(known, F.left(p, F.lit(2))), n(p)))
        return F.filter(prefixes, lambda p: fits(p) & mod97(p))

    return let(let(groups, passing), lambda found: F.get(found, F.size(found) - 1))


def _confirmed(kind: Kind, span: Column) -> Column:
    n = F.length(_digits(span))
    if kind.name == "ip":
        return span.rlike(rf"^{_DIGIT_PART}(?:\.{_DIGIT_PART}){{3}}$")
    if kind.name in ("card", "short_card"):
        return luhn(_digits(span))
    if kind.name == "phone":
        return n.between(10, 15)
    return F.lit(True)


def _before(lengths: Column) -> Column:
    """Sum of all earlier entries at each place, in blocks, so that very many entries do not cost their square."""
    n = F.size(lengths)
    block = F.greatest(F.lit(1), F.ceil(F.sqrt(n.cast("double")))).cast("int")

    def sums(values: Column, start: Column) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("all"))
        step = lambda a, x: F.struct((a["at"] + x).alias("at"), F.concat(a["all"], F.array(a["at"])).alias("all"))
        return F.aggregate(values, empty, step)["all"]

    def blocked(b: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(n / b).cast("int") - 1, F.lit(0))), lambda i: F.slice(lengths, i * b + 1, b))
        totals = F.transform(parts, lambda p: F.aggregate(p, F.lit(0), lambda a, x: a + x))
        return F.flatten(F.zip_with(parts, sums(totals, F.lit(0)), lambda p, s: sums(p, s)))

    return let(block, blocked)


def _spans(text: Column, number: int, kind: Kind) -> Column:
    """Spans of one kind as ``array<struct<start, kind, end, score>>``."""

    def found(pair: Column) -> Column:
        hits, gaps = pair["hits"], pair["gaps"]
        lengths = F.zip_with(
            F.transform(F.slice(gaps, 1, F.size(hits)), lambda g: F.char_length(g)),
            F.transform(hits, lambda h: F.char_length(h)),
            lambda g, h: g + h,
        )
        starts = let(lengths, _before)

        def span(start: Column, i: Column) -> Column:
            hit, gap = F.get(hits, i), F.get(gaps, i)
            context = F.lower(F.concat_ws(" ", F.right(gap, F.lit(CONTEXT)), F.left(F.get(gaps, i + 1), F.lit(CONTEXT))))
            begin = start + F.char_length(gap)
            score = F.lit(kind.prior) + F.when(context.rlike(kind.context), F.lit(BOOST)).otherwise(F.lit(0.0))
            score = F.when(_confirmed(kind, hit), F.least(score, F.lit(1.0))).otherwise(F.lit(0.0))
            return F.struct(
                begin.cast("int").alias("start"),
                F.lit(number).alias("kind"),
                (begin + F.char_length(hit)).cast("int").alias("end"),
                score.alias("score"),
            )

        def account(start: Column, i: Column) -> Column:
            # the hit is only where a number may start: a run may go on into the next words, and the next number
            begin = start + F.char_length(F.get(gaps, i))

            def taken(hit: Column) -> Column:
                end = begin + F.char_length(hit)
                before = F.substring(text, F.greatest(begin - CONTEXT, F.lit(0)) + 1, F.least(begin, F.lit(CONTEXT)))
                context = F.lower(F.concat_ws(" ", before, F.substring(text, end + 1, F.lit(CONTEXT))))
                score = F.lit(kind.prior) + F.when(context.rlike(kind.context), F.lit(BOOST)).otherwise(F.lit(0.0))
                return F.struct(
                    begin.cast("int").alias("start"),
                    F.lit(number).alias("kind"),
                    end.cast("int").alias("end"),
                    F.when(hit.isNotNull(), F.least(score, F.lit(1.0))).otherwise(F.lit(0.0)).alias("score"),
                )

            return let(_account(F.substring(text, begin + 1, F.lit(_IBAN_SPAN + 1))), taken)

        if kind.name == "iban":
            good = F.filter(F.transform(starts, account), lambda s: s["score"] >= THRESHOLD)
            end = lambda a: F.coalesce(F.get(a, F.size(a) - 1)["end"], F.lit(0))
            step = lambda a, s: F.when(s["start"] < end(a), a).otherwise(F.concat(a, F.array(s)))
            return F.aggregate(good, F.array().cast(f"array<{SPAN}>"), step)
        return F.filter(F.transform(starts, span), lambda s: s["score"] >= THRESHOLD)

    none = F.array().cast(f"array<{SPAN}>")
    hits = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pair = let(
        hits,
        lambda h: F.when(F.size(h) > 0, let(F.struct(h.alias("hits"), F.split(text, kind.pattern, -1).alias("gaps")), found)).otherwise(none),
    )
    # a cheap test first: most texts hold nothing that a kind could start with
    digits = r"[0-9][\x20-]?[0-9]" if kind.name in ("card", "short_card") else "[0-9]{2}"
    possible = F.contains(text, F.lit(kind.needs)) if kind.needs else text.rlike(digits)
    return F.when(possible, pair).otherwise(none)


def find(docs: DataFrame, text_col: str = "text", into: str = "pii") -> DataFrame:
    """``docs`` with ``into``: all spans by start, then kind, as ``array<struct<start, kind, end, score>>``.

    ``kind`` is the place in ``KINDS``.
    """
    text = text_of(F.col(text_col))
    # the text is read into a variable once, then eight kinds look at it
    every = let(text, lambda t: F.array_sort(F.concat(*[_spans(t, i, k) for i, k in enumerate(KINDS)])))
    return docs.withColumn(into, every)


def _kind_names(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(k.name) for k in KINDS]), kind + 1)


def joined(spans: Column) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    one = lambda s: F.concat_ws(":", _kind_names(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets (of overlapping spans, the first by start and kind)."""
    state = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(a: Column, s: Column) -> Column:
        kept = F.substring(text, a["at"] + 1, s["start"] - a["at"])
        more = F.concat(a["out"], kept, F.lit("["), _kind_names(s["kind"]), F.lit("]"))
        return F.when(s["start"] < a["at"], a).otherwise(F.struct(s["end"].alias("at"), more.alias("out")))

    done = lambda a: F.concat(a["out"], F.substring(text, a["at"] + 1, 2**31 - 1))
    return F.aggregate(spans, state, step, done)
