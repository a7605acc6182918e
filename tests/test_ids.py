"""Golden rows and edge cases of ids, keys and dates."""

import random

import pytest
from pyspark.sql import functions as F

from pairloom import functions as ids
from pairloom.rules import PLACEHOLDERS

GOLDEN_KEYS = [
    # uuid, SKU first, UPC first
    ("0012<>SKU9<>chewy<>chewy", "sku9<>chewy<>chewy", "12<>chewy<>chewy"),
    ("000<>S1<>a<>b", "s1<>a<>b", "s1<>a<>b"),
    ("0<>0<>a<>b", "<>a<>b", "<>a<>b"),
    ("-<>-<>a<>b", "-<>a<>b", "-<>a<>b"),
    ("12<>NA<>a<>b", "12<>a<>b", "12<>a<>b"),
    ("<>007<>a<>b", "007<>a<>b", "007<>a<>b"),
    ("1<>S2<>a<>b", "s2<>a<>b", "s2<>a<>b"),
    ("01<>S2<>a<>b", "s2<>a<>b", "s2<>a<>b"),
    ("12<>Ä●<>A<>b", "ä●<>a<>b", "12<>a<>b"),
    ("5<>●<>a<>b", "5<>a<>b", "5<>a<>b"),
    ("12<>x", None, None),
    ("", None, None),
    (None, None, None),
]


def column(spark, values, expression, schema="v string"):
    df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values], schema)
    return [r[0] for r in df.select(expression.alias("out")).collect()]


@pytest.mark.parametrize("prefer,place", [("sku", 1), ("upc", 2)])
def test_join_key(spark, prefer, place):
    got = column(spark, [g[0] for g in GOLDEN_KEYS], ids.join_key("v", prefer))
    assert got == [g[place] for g in GOLDEN_KEYS]


def test_join_key_preference_by_row(spark):
    got = column(spark, [("12<>S<>a<>b", "pets"), ("12<>S<>a<>b", "grocery"),
                         ("12<>S<>a<>b", None)],
                 ids.join_key("v", F.col("segment") == "pets"), "v string, segment string")
    assert got == ["s<>a<>b", "12<>a<>b", "12<>a<>b"]


def test_lacks_ids(spark):
    values = ["0<>NA<>a<>b", "12<>NA<>a<>b", "-<>S<>a<>b", "<><>a<>b"]
    assert column(spark, values, ids.lacks_ids("v")) == [True, False, False, True]


def test_product_uuid(spark):
    rows = [("1", "2", "a_b"), ("1", "2", "feed_a_b"), ("1", "2", "solo"), ("1", "2", "a_"),
            ("1", "2", "_b"), ("1", "2", None), (None, "2", "a_b"), ("", "", "a_b")]
    assert column(spark, rows, ids.product_uuid("u", "s", "st"), "u string, s string, st string") \
        == ["1<>2<>a<>b", "1<>2<>a<>b", None, "1<>2<>a<>", "1<>2<><>b", None, None, "<><>a<>b"]


def test_stores(spark):
    assert column(spark, ["1<>2<>A<>b", "1<>2<>A", None], ids.store_key("v")) \
        == ["A<>b", None, None]
    assert column(spark, ["a_b", "solo", "a_", None], ids.store_from_uuid("v")) \
        == ["b_b", "solo_solo", "_", None]


@pytest.mark.parametrize("zone", ["UTC", "America/Sao_Paulo", "Pacific/Auckland"])
def test_epoch_ignores_the_session_zone(spark, conf, zone):
    conf({"spark.sql.session.timeZone": zone})
    rows = [("5", "1", "2024"), ("05", "01", "2024"), ("21", "10", "2018"), ("31", "02", "2024"),
            (None, "01", "2024"), ("x", "1", "2024"), ("1", "1", "1970"), ("1", "1", "1900")]
    assert column(spark, rows, ids.parts_to_epoch("d", "m", "y"), "d string, m string, y string") \
        == [1704412800, 1704412800, 1540080000, None, None, None, 0, -2208988800]


def test_epoch_int(spark):
    assert column(spark, ["12", "x", "99999999999", None], ids.to_epoch_int("v")) \
        == [12, None, None, None]


def test_turned_is_never_null(spark):
    rows = [("a", "b"), ("b", "a"), ("a", "a"), (None, "a"), ("a", None), (None, None)]
    assert column(spark, rows, ids.turned("a", "b"), "a string, b string") \
        == [False, True, False, False, True, False]


def test_replace_all_takes_text_literally(spark):
    assert column(spark, ["a.ba.b", "axb", None], ids.replace_all("v", {"a.b": "c", "cc": "d"})) \
        == ["d", "axb", None]


def python_key(uuid, prefer):
    """The key by its definition, part by part."""
    parts = uuid.lstrip("0").lower().split("<>")
    if len(parts) < 4:
        return None
    upc, sku, source, store = parts[:4]
    if sku in PLACEHOLDERS:
        first = upc
    elif upc in PLACEHOLDERS:
        first = sku
    else:
        first = sku if prefer == "sku" else upc
    return f"{first}<>{source}<>{store}"


@pytest.mark.parametrize("prefer", ["sku", "upc"])
def test_join_key_of_random_uuids(spark, prefer):
    rnd = random.Random(3)
    words = ["", "0", "00", "012", "NA", "n/A", "●", "Ab_1", "-", "<", ">", "0-", "É", "nan"]
    uuids = ["<>".join(rnd.choice(words) for _ in range(rnd.randint(1, 6))) for _ in range(2000)]
    assert column(spark, uuids, ids.join_key("v", prefer)) == [python_key(u, prefer) for u in uuids]
