"""Secret scans against the patterns applied to every text, and the ledger's increments."""

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starmart.llm import secrets as S
from starmart.llm.secrets import BlobLedger

DOCS = "doc_id long, text string, kind string, blob int"
KEY = "AKIA" + "Z9" * 8
TEXTS = [
    'password = "hunter2-and-more"',
    "PassWord:'abcdef' token=abc; token: abcdef",
    "password: token: abcdefgh",  # the first match ends before the second could begin
    "api_key=12345 apikey=123456 API_KEY : 1234567",
    "pasſword=abcdefg Key api_Key=abcdefgh",  # letters that only fold to ASCII
    f"x{KEY}y AKIA AKIA123 {KEY}{KEY} AKIAAKIA{'A' * 20}",
    f"{'0af3' * 6} {'0af3' * 5}fff {'AF' * 20} é{'d' * 30}g",
    f"secret={'ab' * 20}",
    f"ÄÖ😀 token={KEY}",
    "",
    None,
    "word " * 200_000 + "passwd=qwertyuiop",
]
BASE = {
    "assign": re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "hex": re.compile(r"[0-9a-f]+"),
}
LEAST = {"assign": 6, "access": 20, "hex": 24}


def expected(text):
    found = []
    for rank, (kind, pattern) in enumerate(BASE.items()):
        for m in pattern.finditer(text or ""):
            if len(m[2] if kind == "assign" else m[0]) >= LEAST[kind]:
                found.append((m.start(), rank, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(found)]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "x", 1) for i, t in enumerate(TEXTS)]
    rows += [(3, TEXTS[3], "x", 1), (3, TEXTS[0], None, None), (None, TEXTS[0], "x", 1), (None, TEXTS[0], "x", 1), (None, None, None, None)]
    return spark.createDataFrame(rows, DOCS)


def got(df):
    return sorted(((r["doc_id"], [tuple(f) for f in r["findings"]]) for r in df.collect()), key=str)


def test_findings_equal_the_patterns(spark, docs):
    want = sorted(((r["doc_id"], expected(r["text"])) for r in docs.collect()), key=str)
    assert sum(len(f) for _, f in want) > 15
    assert got(S.scan(docs, BlobLedger.temporary(spark))) == want


def test_only_unseen_pairs_are_scanned(spark, docs):
    ledger = BlobLedger.temporary(spark)
    half = docs.where("doc_id < 6")
    S.scan(half, ledger)
    texts = len({r["text"] or "" for r in docs.collect()})
    seen = len({r["text"] or "" for r in half.collect()})
    assert ledger.read().count() == seen * 3

    unseen = S.unseen_pairs(S.blobs(docs), ledger)
    assert unseen.count() == texts - seen
    whole = got(S.scan(docs, ledger))
    assert ledger.read().count() == texts * 3
    assert S.unseen_pairs(S.blobs(docs), ledger).count() == 0
    assert got(S.scan(docs, ledger)) == whole
    assert ledger.read().count() == texts * 3

    # A new version of one rule: every blob again, for this rule alone; old findings no longer count.
    rules = tuple(replace(r, version=2, pattern="[0-9a-f]{23,}") if r.kind == "hex" else r for r in S.RULES)
    unseen = S.unseen_pairs(S.blobs(docs), ledger, rules).select("unseen").distinct().collect()
    assert [r["unseen"] for r in unseen] == [[2]]
    longer = S.scan(docs, ledger, rules=rules)
    assert ledger.read().count() == texts * 4
    assert ledger.read().where("version = 2").select("kind").distinct().count() == 1
    assert sum(len(f) for _, f in got(longer)) == sum(len(f) for _, f in whole) + 1
    assert got(S.scan(docs, ledger)) == whole


def test_pair_appended_twice_counts_once(spark, docs):
    ledger = BlobLedger.temporary(spark)
    whole = got(S.scan(docs, ledger))
    ledger.append(ledger.read().where(F.size("spans") > 0))
    assert got(S.scan(docs, ledger)) == whole


def test_empty(spark, docs):
    ledger = BlobLedger.temporary(spark)
    assert S.scan(docs.where("false"), ledger).count() == 0
    assert ledger.read().count() == 0
