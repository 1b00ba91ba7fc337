"""Random strings and ordinary identifiers that no training text holds."""

import random
import string

import pytest

from panelwright.llm import secret_scan

FOLDER = "/root/testdata/sf0.01"

ORDINARY = """
/usr/lib/python3.13/site-packages/numpy/core MAX_CONNECTION_POOL_SIZE_V2_DEFAULT AbstractSingletonProxyFactoryBean2Impl
kubernetes-dashboard-certs-v1beta1 images/2024/05/header-background-large.png 2024-01-01_to_2024-12-31
org.apache.spark.sql.catalyst.expressions getUserAccountInformationById internationalizationConfigurationManagement
com.example.service.UserRepositoryImpl /var/log/nginx/access.log.2024-03-15 my-application-frontend-service-7
TestCaseForDatabaseConnectionPooling SOME_VERY_LONG_CONSTANT_NAME_HERE src/main/java/com/company/project/Main.java
release-candidate-2.14.0-beta.3 quarterly_report_final_version_3.xlsx XMLHttpRequestEventTarget
docker.io/library/postgres ThisIsAnOrdinaryClassName1 customer_account_balance_history_2023
http-client-connection-timeout-ms 2023-10-05T14.48.00.000Z abcdefghijklmnopqrstuvwxyz
""".split()  # names of our own, in the usual styles

ALPHABETS = {
    "base62": string.ascii_letters + string.digits,
    "base64": string.ascii_letters + string.digits + "+/",
    "base32": string.ascii_uppercase + "234567",
    "hex": "0123456789abcdef",
    "letters": string.ascii_letters,
    "small letters": string.ascii_lowercase,
}


@pytest.fixture(scope="module")
def scan(spark):
    return secret_scan.scanner(secret_scan.train(spark.read.parquet(f"{FOLDER}/documents.parquet")))


def random_spans(scan, run):
    return [s for s in scan(f"see {run} there") if s[3] == "random"]


def test_ordinary_identifiers_are_left_alone(scan):
    called = [name for name in ORDINARY if random_spans(scan, name)]
    assert len(ORDINARY) == 24 and len(called) <= 1, called


@pytest.mark.parametrize("kind", sorted(ALPHABETS))
@pytest.mark.parametrize("length", [20, 24, 31])
def test_random_strings_are_found(scan, kind, length):
    rng = random.Random(length)
    drawn = ["".join(rng.choices(ALPHABETS[kind], k=length)) for _ in range(300)]
    found = sum(bool(random_spans(scan, run)) for run in drawn)
    assert found >= 0.94 * len(drawn), found


def test_identifiers_made_of_held_out_words(spark, scan):
    """Precision: names joined from words of another table, in six styles."""
    rng = random.Random(9)
    words = set()
    for (text,) in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect():
        words |= {w for w in (text or "").split() if w.isascii() and w.isalpha() and 3 <= len(w) <= 12}
    words = sorted(words)
    styles = [
        lambda w: "_".join(w).lower(), lambda w: "-".join(w).lower(), lambda w: "".join(x.capitalize() for x in w),
        lambda w: "_".join(w).upper(), lambda w: "/".join(w).lower(), lambda w: ".".join(w).lower() + str(rng.randrange(30)),
    ]
    names = [style(rng.sample(words, 4)) for _ in range(150) for style in styles]
    called = [n for n in names if random_spans(scan, n)]
    assert len(called) <= 0.02 * len(names), called[:10]


def test_runs_of_one_kind_are_never_random(scan):
    for run in ("-" * 40, "=" * 40, "ab" * 20, "." * 30, "0123456789" * 3, "1" * 30, "4539148803436467123", "192.168.101.117.22"):
        assert not random_spans(scan, run), run


def test_short_random_strings(scan):
    """Runs of 16 to 19 characters are judged too, by the same whole ratio."""
    rng = random.Random(3)
    drawn = ["".join(rng.choices(ALPHABETS["base62"], k=16)) for _ in range(300)]
    assert sum(bool(random_spans(scan, run)) for run in drawn) >= 0.85 * len(drawn)
    assert not random_spans(scan, "applicationframe") and not random_spans(scan, "the_connection_1")


def test_no_samples_at_all(spark, docs_of):
    """Empty tables and wordless texts: the models start from even odds and call nothing by mistake."""
    for docs in (docs_of("x").limit(0), docs_of(None, ""), docs_of("123 456", "…")):
        chains = secret_scan.train(docs)
        assert chains.random.shape == chains.ordinary.shape == (68, 68)
        assert secret_scan.digest(docs).count() == docs.count()
