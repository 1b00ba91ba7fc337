"""Personal data in texts: regular expressions propose, checksums confirm, nearby words adjust the score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What each kind looks like, and the words that speak for it in the 40 characters before.
# Lookarounds only keep a failed attempt from being repeated at every later character of the same run.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?:(?<![0-9])|\G)[0-9]++(?:\.[0-9]++){3}"
CARD = r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,18}+(?![ -]?[0-9])"
PHONE = r"\+[0-9](?:[ ().-]*+[0-9]){9,14}+(?![ ().-]*+[0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}+(?![A-Za-z0-9])"
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"

#: kind: (pattern, cheap test that any match passes, words nearby, score without them, least score)
KINDS = {
    "email": (EMAIL, "@", r"mail|contact|write|reach", 0.9, 0.0),
    "ip": (IP, r"[0-9]\.[0-9]", r"\bip\b|address|host|server", 0.6, 0.0),
    "card": (CARD, r"[0-9](?:[ -]?[0-9]){13}", r"card|visa|credit|payment", 0.7, 0.0),
    "phone": (PHONE, r"\+[0-9]", r"phone|\btel|call|mobile|fax", 0.7, 0.0),
    "iban": (IBAN, r"[A-Z]{2}[0-9]{2}", r"iban|bank|account|konto", 0.8, 0.5),
    "ssn": (SSN, r"[0-9]{3}-[0-9]{2}-", r"ssn|social|security", 0.3, 0.5),
}
BASE = ("email", "ip", "card", "phone")
NEAR = 40
CONTEXT_GAIN = 0.3

_FOUND = "array<struct<start:int,end:int,text:string,before:string>>"


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of `text` pass the Luhn check."""
    digits = F.reverse(_digits(text))
    doubled = F.translate(digits, "0123456789", "0246813579")
    places = F.sequence(F.lit(1), F.length(digits))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda sum_, k: sum_
        + F.when(k % 2 == 0, F.substring(doubled, k, F.lit(1))).otherwise(F.substring(digits, k, F.lit(1))).cast("int"),
    )
    return total % 10 == 0


def mod_97(text: Column) -> Column:
    """Whether an account number passes the mod-97 check (letters count as 10 to 35)."""
    plain = F.regexp_replace(text, " ", "")
    turned = F.concat(F.substring(plain, F.lit(5), F.length(plain)), F.substring(plain, F.lit(1), F.lit(4)))
    rest = F.aggregate(
        F.split(turned, ""),
        F.lit(0),
        lambda rest, c: F.when(c == "", rest)
        .when(c.rlike("[0-9]"), (rest * 10 + c.cast("int")) % 97)
        .otherwise((rest * 100 + F.ascii(c) - 55) % 97),
    )
    return rest == 1


def _confirmed(kind: str, text: Column) -> Column:
    if kind == "ip":
        return text.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$")
    if kind == "card":
        return luhn(text)
    if kind == "iban":
        return mod_97(text)
    return F.lit(True)


def _proposed(text: Column, pattern: str, probe: str) -> Column:
    """Matches with their code points: lengths of the matches and of the text between them, added up."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    steps = F.zip_with(between, found, lambda b, m: F.struct(b.alias("before"), m.alias("text")))
    empty = F.array().cast(_FOUND)
    walked = F.aggregate(
        steps,
        F.struct(F.lit(0).alias("at"), empty.alias("out")),
        lambda acc, s: F.struct(
            (acc["at"] + F.length(s["before"]) + F.length(s["text"])).alias("at"),
            F.concat(
                acc["out"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(s["before"])).alias("start"),
                        (acc["at"] + F.length(s["before"]) + F.length(s["text"])).alias("end"),
                        s["text"].alias("text"),
                        F.lower(F.substring(s["before"], -NEAR, NEAR)).alias("before"),
                    )
                ),
            ).alias("out"),
        ),
        lambda acc: acc["out"],
    )
    might = F.contains(text, F.lit(probe)) if probe == "@" else text.rlike(probe)
    return F.when(might, walked).otherwise(empty)


def _checked(rank: int, kind: str) -> Column:
    """The proposed spans of a kind that its checksum and its score let pass."""
    _, _, words, plain, least = KINDS[kind]
    real = F.filter(f"raw_{kind}", lambda s: _confirmed(kind, s["text"]))
    near = F.lit(min(1.0, plain + CONTEXT_GAIN))
    scored = F.transform(
        real,
        lambda s: F.struct(
            s["start"].alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].alias("end"),
            F.lit(kind).alias("kind"),
            s["text"].alias("text"),
            F.when(s["before"].rlike(words), near).otherwise(F.lit(plain)).alias("score"),
        ),
    )
    return F.filter(scored, lambda s: s["score"] >= least)


def _count(kind: str) -> Column:
    return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, found): `found` holds (start, rank, end, kind, text, score) in order of start, then kind.

    Starts and ends count code points, ends exclusive; matches of one kind never overlap, of two kinds may. A null
    text counts as empty, and an empty one has no spans. Rows are neither merged nor dropped, whatever their
    doc_id. Extra columns are ignored.
    """
    out = docs.select(
        F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )
    out = out.select("*", *[_proposed(F.col("text"), k[0], k[1]).alias(f"raw_{n}") for n, k in KINDS.items()])
    checked = [_checked(rank, kind) for rank, kind in enumerate(KINDS)]
    return out.select("doc_id", "text", F.array_sort(F.concat(*checked)).alias("found"))


def joined_spans(found: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Counts and spans of each document, in the columns that the query promises."""
    found = find_spans(docs)
    base = found.select(
        "doc_id", "found", F.filter("found", lambda s: s["kind"].isin(*BASE)).alias("base")
    )
    return base.select(
        "doc_id",
        *[_count(kind) for kind in BASE],
        F.sha2(joined_spans(F.col("base")), 256).alias("base_sha256"),
        joined_spans(F.col("found")).alias("spans"),
        F.coalesce(F.array_max(F.transform("found", lambda s: s["score"])), F.lit(0.0)).alias("top_score"),
    )
