"""Random inputs against plain Python, in one Spark job per function."""

import random
import string

import pytest
from pyspark.sql import functions as F

from harvestlake import refdata
from harvestlake.functions import licences, relevance, text

ALPHABET = string.ascii_letters + "..//  -__0149\t 　​ÄÉß"
PIECES = [
    "cc-by", "CC BY", "cc0", "Public Domain", "4.0", "2.5", "ODC-BY", "pddl", "doi:", "DOI:", ".html",
    "https://spdx.org/licenses/", "/licenses/", "interview", "Focus Group", "field note", "coded",
]


def samples(seed, n=600):
    rng = random.Random(seed)
    return [
        "".join(
            rng.choice(PIECES) if rng.random() < 0.3 else rng.choice(ALPHABET)
            for _ in range(rng.randrange(9))
        )
        for _ in range(n)
    ]


def extension(name):
    head, dot, tail = name.rpartition(".")
    return tail.lower() if dot else ""


def spdx(raw):
    if "spdx.org/licenses/" not in raw:
        return raw.lower()
    return raw[raw.rindex("/licenses/") + len("/licenses/"):].replace(".html", "").lower()


def display(name):
    short = name.strip().lower().translate(str.maketrans(" /", "--"))
    return "cc0" if short in ("cc0", "cc-zero", "public-domain") else short


def title_points(title):
    return sum(k in title.lower() for k in refdata.TITLE_KEYWORDS)


@pytest.mark.parametrize(
    "build, python",
    [
        (text.file_extension, extension),
        (licences.spdx_licence, spdx),
        (licences.display_name_licence, display),
        (text.is_not_blank, lambda s: bool(s.strip())),
        (licences.is_open_licence, lambda s: s.lower().startswith(tuple(refdata.OPEN_LICENCE_PREFIXES))),
        (relevance.title_score, title_points),
    ],
)
def test_like_python(column, build, python):
    values = samples(str(python))
    assert column(build, values) == [python(v) for v in values]


def test_query_match_like_python(spark):
    from harvestlake.operators.matching import match_queries

    texts = samples("texts", 400)
    queries = ['"cc by"', "interview coded", '"focus group" doi:', "PDDL", '"field note"', "  "]
    df = spark.createDataFrame(list(enumerate(texts)), "i INT, body STRING")
    got = {(r["i"], r["query_idx"]) for r in match_queries(df, queries, "body").collect()}
    expected = {
        (i, q)
        for i, body in enumerate(texts)
        for q, query in enumerate(queries)
        if (terms := refdata.query_terms(query)) and all(t.lower() in body.lower() for t in terms)
    }
    assert got == expected and len(expected) > 20
    assert match_queries(df, ["interview"], "body").select(F.max("query")).first()[0] == "interview"
