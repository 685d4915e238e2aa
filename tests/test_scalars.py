import hashlib

import pytest
from pyspark.sql import functions as F

from trailmark.functions import scalars as S

NB = " "


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(make(F.col("c"))).collect()]


def test_canonical_url(spark):
    cases = {
        "o/r": "o/r", "/o/r/": "o/r", "github.com/o/r.git": "o/r", "https://github.com/github.com/o/r": "o/r", "http://github.com/o/r": "http://github.com/o/r", "o/r.git/": "o/r", "o/r.git.git": "o/r.git",
        NB + "o/r": "o/r", "/ o/r /": " o/r ", "https://github.com//o/r": "/o/r", "": "", None: "", "\t O/R \n": "O/R", "　o/r ": "o/r", "//o/r//": "o/r", "git@github.com:o/r": "git@github.com:o/r", "https://GitHub.com/o/r": "https://GitHub.com/o/r",
    }
    assert column(spark, cases, S.canonical_url) == ["https://github.com/" + v for v in cases.values()]


def test_paths(spark):
    cases = {
        "././/a": ("a", ["a"]), "/./a": ("./a", [".", "a"]), ".//./a": ("./a", [".", "a"]), "\\a\\b": ("/a/b", ["a", "b"]), ".\\a": ("./a", [".", "a"]), "a//b/": ("a//b/", ["a", "b"]), "../a": ("../a", ["..", "a"]),
        "./": ("", []), ".git/x": (".git/x", [".git", "x"]), "a/./b": ("a/./b", ["a", ".", "b"]), "": ("", []), None: ("", []), "  a b \n": ("a b", ["a b"]), "é/ü": ("é/ü", ["é", "ü"]), "/": ("", []),
    }
    assert column(spark, cases, S.normalize_path) == [v[0] for v in cases.values()]
    assert [[bytes(x).decode() for x in p] for p in column(spark, cases, S.path_components)] == [v[1] for v in cases.values()]


def test_parse_bin(spark):
    cases = {"48": 48, " 50 ": 50, "+60": 60, "-1": 0, "3": 3, "65535": 65535, "65536": 0, "": 0, "abc": 0, "0048": 48, "4.5": 0, NB + "49": 49, None: 0, "+": 0, "0": 0, "99999999999999999999": 0, "00000000000000000007": 7}
    assert column(spark, cases, S.parse_bin) == list(cases.values())


def test_ids(spark):
    h = "0123456789abcdef0123456789abcdef01234567"
    assert column(spark, ["x", "swh:1:rev:x", None], S.revision_swhid) == ["swh:1:rev:x", "swh:1:rev:x", "swh:1:rev:"]
    assert column(spark, ["https://github.com/o/r"], S.origin_swhid) == ["swh:1:ori:" + hashlib.sha1(b"https://github.com/o/r").hexdigest()]
    for n, want in ((0, ""), (1, "0"), (7, h[:7]), (40, h), (99, h)):
        assert column(spark, ["swh:1:rev:" + h], lambda c: S.hash_prefix(c, n)) == [want]
    assert column(spark, ["ABCDEF0123", "abc", "xyz", None], lambda c: S.commit_key(c, 7)) == ["abcdef0", "abc", None, ""]
    q = lambda c: S.qualified_id(F.lit("C"), F.lit("O"), F.lit(""), F.lit("R"), c)
    assert column(spark, ["\\a", "./x/y"], q) == ["C;origin=O;visit=;anchor=R;path=//a", "C;origin=O;visit=;anchor=R;path=/x/y"]


@pytest.mark.parametrize("ids,want", [(["a" * 40, "B" * 40], True), (["a" * 40, "abc"], False), ([], False), ([None], False), (["g" * 40], False), (["a" * 40 + "\n"], False)])
def test_full_hash_mode(spark, ids, want):
    df = spark.createDataFrame([(i,) for i in ids], "c string")
    assert df.agg(S.all_full_hashes("c")).first()[0] is want


def test_status(spark):
    assert column(spark, ["ok", "submodule", "no_root"], S.output_status) == ["ok", "path_not_found", "path_not_found"]
