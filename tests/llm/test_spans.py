"""Personal data and secrets against plain regular expressions."""

import hashlib
import random
import re

import pytest

from panelwright.llm import pii, secret_scan

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
SECRETS = {
    "assign": re.compile(
        r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]"""
        r"""|[aA][pP][iI]_?[kK][eE][yY])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    ),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}


def luhn(digits):
    return sum(sum(divmod(2 * int(c), 10)) if k % 2 else int(c) for k, c in enumerate(reversed(digits))) % 10 == 0


def passes(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        return 14 <= len(digits) <= 19 and luhn(digits)
    return kind == "email" or 10 <= len(digits) <= 15


def personal(text):
    return sorted(
        (m.start(), rank, m.end(), kind)
        for rank, (kind, pattern) in enumerate(BASE.items())
        for m in re.finditer(pattern, text or "")
        if passes(kind, m.group())
    )


def secret(text):
    found = []
    for rank, (kind, pattern) in enumerate(SECRETS.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2]) >= 8 if rank == 0 else m.end() - m.start() >= (16, 32)[rank - 1]:
                found.append((m.start(), rank, m.end(), kind))
    return sorted(found)


def check(rows, texts, expected, kinds):
    assert len(rows) == len(texts)
    for row in rows:
        spans = expected(texts[row["doc_id"] - 1])
        joined = ",".join(f"{k}:{a}:{b}" for a, _, b, k in spans)
        assert ",".join(s for s in row["spans"].split(",") if s.split(":")[0] in kinds) == joined
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        for kind in kinds:
            assert row[f"n_{kind}"] == sum(s[3] == kind for s in spans)


def fuzz(alphabet, n=400):
    source = random.Random(5)
    return [None, "", "x"] + ["".join(source.choices(alphabet, k=source.choice([20, 60, 400]))) for _ in range(n)]


def test_personal_data_equals_plain_patterns(docs_of):
    texts = fuzz("0123456789 -+.()@aZ_é𝒳 12 34 5.6.7.8 %") + [
        "4111 1111 1111 1111 and 4111-1111-1111-1111-",
        "a@b.c_d@e.f a@b.c.d@e.f",
        "1.2.3.400.5.6.7.8 1.2.3.4.5.6.7.8 0255.1.1.1 256.1.1.1",
        "+1 (017) 555-7713%",
        "a" * 100_000,
        "1" * 100_000,
        "1." * 20_000,
        "+1 " * 20_000,
    ]
    check(pii.digest(docs_of(*texts)).collect(), texts, personal, BASE)


def test_checksums_and_context_add_spans(docs_of):
    texts = ["IBAN DE89370400440532013000 x", "DE89370400440532013001", "my ssn: 123-45-6789", "no 123-45-6789"]
    spans = {r["doc_id"]: r["spans"] for r in pii.digest(docs_of(*texts)).collect()}
    assert spans == {1: "iban:5:27", 2: "", 3: "ssn:8:19", 4: ""}


def test_context_raises_the_score(docs_of):
    rows = pii.find_spans(docs_of("call +1 (017) 555-7713", "+1 (017) 555-7713")).collect()
    near, plain = (next(iter(r["found"]))["score"] for r in sorted(rows, key=lambda r: r["doc_id"]))
    assert near > plain


def test_personal_data_runs_without_python(docs_of):
    plan = pii.digest(docs_of("a"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_secrets_equal_plain_patterns(docs_of):
    words = ["token", "API_KEY", "passwd", "=", ":", '"', "'", " ", "abcdefgh", "0123456789abcdef" * 2, "AKIA" + "Z9" * 6]
    source = random.Random(3)
    texts = [None, "", "é token = 'abcdefgh1' é"] + ["".join(source.choices(words, k=12)) for _ in range(300)]
    texts += ["ſecret=abcdefgh toKen=abcdefgh", "a" * 50_000, "token " * 5_000]
    check(secret_scan.digest(docs_of(*texts)).collect(), texts, secret, SECRETS)


def test_random_strings_are_told_from_words(docs_of):
    source = random.Random(1)
    words = ["the", "quick", "brown", "configuration", "management", "internationalization", "of", "things"]
    plain = [" ".join(source.choices(words, k=80)) for _ in range(60)]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    hidden = ["see " + "".join(source.choices(letters, k=32)) + " there" for _ in range(20)]
    samples = ["token = " + "".join(source.choices(letters, k=32)) for _ in range(60)]
    rows = secret_scan.digest(docs_of(*plain, *hidden, *samples)).collect()
    found = {r["doc_id"] for r in rows if r["n_random"]}
    assert found <= set(range(61, 81))
    assert len(found) >= 18


def test_random_letters_are_told_from_identifiers(docs_of):
    source = random.Random(2)
    words = ["the", "quick", "brown", "configuration", "management", "internationalization", "of", "things", "Proxy", "Factory"]
    plain = [" ".join(source.choices(words, k=80)) for _ in range(60)]
    names = ["internationalizationConfigurationManagement", "quickBrownProxyFactoryManagement", "the_configuration_of_the_things"]
    plain += [f"see {n} there" for n in names] + ["-" * 40, "=" * 40, "_" * 30, "ab" * 20]
    letters = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    hidden = ["see " + "".join(source.choices(letters, k=32)) + " there" for _ in range(40)]
    samples = ["token = " + "".join(source.choices(letters + "0123456789", k=32)) for _ in range(60)]
    rows = secret_scan.digest(docs_of(*plain, *hidden, *samples)).collect()
    found = {r["doc_id"] for r in rows if r["n_random"]}
    assert found <= set(range(len(plain) + 1, len(plain) + 41))
    assert len(found) >= 36


def test_redaction_keeps_rows_and_columns(docs_of):
    docs = docs_of("a token = abcdefgh1 b", None, "", "plain")
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns
    assert {tuple(r) for r in out.collect()} == {
        (1, "a [secret] b", "x", "y"),
        (2, None, "x", "y"),
        (3, "", "x", "y"),
        (4, "plain", "x", "y"),
    }


@pytest.mark.parametrize("digest", [pii.digest, secret_scan.digest])
def test_empty_table_and_null_ids(docs_of, digest):
    docs = docs_of("a@b.c token=abcdefgh", "a@b.c token=abcdefgh", ids=[None, 1])
    assert digest(docs.limit(0)).count() == 0
    rows = digest(docs.union(docs)).collect()
    assert len(rows) == 4 and len({r["spans"] for r in rows}) == 1
