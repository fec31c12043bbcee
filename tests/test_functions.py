from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from crawlframe.functions import content as C
from crawlframe.functions import headers as H
from crawlframe.functions import urls as U
from crawlframe.functions.text import strip
from crawlframe.profile import SiteProfile
from crawlframe.sources.queue import split_messages

ABSOLUTE = "https://www.gallery.example/user/"


@pytest.mark.parametrize(
    "url, name",
    [
        ("/user/Fern-42", "Fern-42"),
        ("/user/ovalreed/", "ovalreed"),
        (ABSOLUTE + "tin.pail7/", "tin.pail7"),
        ("http://gallery.example/user/a", "a"),
        ("https://wwwXgalleryYexample/user/a/", "a"),
        ("/user/[x]-~9/", "[x]-~9"),
        ("/user/^Quiet_Lane^/", "^Quiet_Lane^"),
        ("/user/Mixed.Case~`_", "Mixed.Case~`_"),
        ("/user/x\n", "x"),
        ("/user/x\r\n", None),
        ("/user/x ", None),
        ("/user/", None),
        ("/user/a b", None),
        ("/user/a/b", None),
        ("/USER/x", None),
        ("x/user/a", None),
        ("https://elsewhere.example/user/a", None),
        ("", None),
        (None, None),
    ],
)
def test_username_from_url(one, url, name):
    assert one(U.username_from_url(F.col("u")), "u string", url) == name


def test_profile_renames_everything(one):
    profile = SiteProfile(site="shop", domain="shop.test")
    assert one(U.username_from_url(F.col("u"), profile), "u string", "http://shop.test/user/q") == "q"
    assert one(U.submission_url(F.col("i"), profile), "i long", 40718263) == (
        "https://www.shop.test/view/40718263/"
    )
    assert profile.stored_submission_id == "shop_submission_id"
    assert profile.attempt_id_header == "shop_scrape_attempt_id"


@pytest.mark.parametrize(
    "href, number",
    [("/view/123/", 123), ("x/view/9/y", 9), ("/view/9", None), ("/view/a/", None),
     ("/view/1/view/2/", 1), ("/view/99999999999999999999/", None)],
)
def test_view_id(one, href, number):
    assert one(U.view_id_from_href(F.col("h")), "h string", href) == number


@pytest.mark.parametrize(
    "url, taken",
    [("https://a.gallery.example/x.gif", True), ("https://,.gallery.example/x", True),
     ("https://b.gallery.example/x", False), ("https://www.gallery.example/themes/beta/css/a", True),
     ("https://www.gallery.example/themes/beta/fonts/a", False)],
)
def test_accepted_requisites(one, url, taken):
    pattern = SiteProfile().accept_pattern
    assert one(U.is_accepted(F.col("u"), pattern), "u string", url) is taken


def test_worker_identity_round_trip(one):
    built = U.worker_identity(F.lit("host-1"), F.lit(31007), F.lit("0.2.7"))
    assert one(built, "x int", 1) == "FQDN[host-1]-PID[31007]-VER[0.2.7]"
    assert one(U.parse_worker_identity(built), "x int", 1).asDict() == {
        "host": "host-1", "pid": 31007, "version": "0.2.7"
    }


def test_archive_names_round_trip(one):
    path = U.blob_path(F.lit("abcdef"), F.lit(12), F.lit(34), "/archive")
    assert one(path, "x int", 1) == "/archive/abc/crawl_content_cid-12_aid-34.tar.xz"
    assert one(U.parse_archive_path(path), "x int", 1).asDict() == {
        "sha_prefix": "abc", "site_id": None, "content_id": 12, "attempt_id": 34
    }
    warc = U.warc_name(F.lit(5), F.lit(6))
    assert one(warc, "x int", 1) == "crawl_content_sid-5_aid-6.warc"
    assert one(U.parse_archive_path(warc), "x int", 1)["site_id"] == 5
    assert one(U.parse_archive_path(F.lit("other.txt")), "x int", 1)["attempt_id"] is None


@pytest.mark.parametrize(
    "size, text",
    [(0, "0.000 Bit"), (1, "1.000 Byte"), (1023, "1023.000 Byte"), (1024, "1.000 KiB"),
     (1088, "1.062 KiB"), (1152, "1.125 KiB"), (1600, "1.562 KiB"), (1048576, "1.000 MiB"),
     (5 * 1024**3, "5.000 GiB"), (2**62, "4.000 EiB"), (None, None)],
)
def test_human_size(one, size, text):
    assert one(C.human_size(F.col("s")), "s long", size) == text


def test_decode_page(one):
    broken = bytes([0x61, 0xFF, 0x62, 0xC3])
    assert one(C.decode_page(F.col("b")), "b binary", broken) == r"a\xffb\xc3"
    assert one(C.encoding_status(F.col("b")), "b binary", broken) == "unicode_decode_error"
    assert one(C.decode_page(F.col("b")), "b binary", "é✓".encode()) == "é✓"
    assert one(C.encoding_status(F.col("b")), "b binary", b"") == "decoded_ok"
    assert one(C.decode_page(F.col("b")), "b binary", None) is None


def test_digest_is_sha512(one):
    import hashlib

    assert one(C.digest(F.col("b")), "b binary", b"xyz") == hashlib.sha512(b"xyz").hexdigest()


def test_file_safe_timestamp(one):
    moment = F.lit("2022-11-05 17:40:09.120345").cast("timestamp_ntz")
    assert one(C.file_safe_timestamp(moment), "x int", 1) == "2022-11-05T17_40_09.120345+0000"


@pytest.mark.parametrize("junk", ["\x1c\x1f", " 　", "\t\r\n \x85\xa0", ""])
def test_strip_is_unicode_aware(one, junk):
    assert one(strip(F.col("t")), "t string", f"{junk}a b\n{junk}") == "a b"
    assert f"{junk}a b\n{junk}".strip() == "a b"


HEADER = "a: 1\r\nbad\r\nb:x:y\r\na: 2\r\n\r\nc: 3\r\n"


def test_warcinfo_headers(one):
    kept = one(H.warcinfo_map(F.col("t")), "t string", HEADER)
    assert kept == {"a": " 2", "b": "x:y"}
    assert one(H.warcinfo_map(F.col("t"), trim_values=True), "t string", HEADER) == {"a": "2", "b": "x:y"}
    assert one(H.warcinfo_map(F.col("t")), "t string", "\na: 1") == {}
    assert one(H.warcinfo_map(F.col("t")), "t string", "k: 1") == {"k": " 1"}
    assert one(H.warcinfo_map(F.col("t")), "t string", None) is None


def test_warcinfo_fields(one):
    text = (
        "software: Wget\nrobots: off\ngallery_scrape_attempt_id: 40718263\n"
        "date: 2023-05-17T08:31:12.250000+00:00\ngallery_submission: 530914\n"
        "program_identity_string: FQDN[node-3]-PID[31007]-VER[0.2.7]\n"
    )
    fields = one(H.warcinfo_fields(H.warcinfo_map(F.col("t"))), "t string", text)
    assert (fields.attempt_id, fields.site_submission_id) == (40718263, 530914)
    assert fields.worker.asDict() == {"host": "node-3", "pid": 31007, "version": "0.2.7"}


def test_messages_split(spark):
    bodies = [b"12", b" 12 ", b"+7", b"-3", b"x", b"1.5", b"1_000", b"", b"\xff", None,
              b"99999999999999999999", " 5".encode()]
    messages = spark.createDataFrame(list(enumerate(bodies)), "delivery_tag long, value binary")
    good, dead = split_messages(messages)
    assert {r.delivery_tag: r.submission_id for r in good.collect()} == {
        0: 12, 1: 12, 2: 7, 3: -3, 11: 5
    }
    assert sorted(r.delivery_tag for r in dead.collect()) == [4, 5, 6, 7, 8, 9, 10]


def test_human_size_of_keys_whose_cube_passes_a_long(spark, tmp_path):
    from workload.content_queries import human

    spark.range(3).selectExpr("element_at(array(5L, 2097152L, 8999999L), int(id) + 1) AS o_orderkey").write.parquet(f"{tmp_path}/orders.parquet")
    rows = {r.o_orderkey: (r.size, r.text) for r in human(spark, str(tmp_path)).collect()}
    assert rows == {5: (125, "125.000 Byte"), 2097152: (None, "8.000 EiB"), 8999999: (None, "632.306 EiB")}
