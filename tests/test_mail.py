import datetime as dt
import html
import random
import re

import pytest
from pyspark.sql import functions as F

from termloom.functions import clean, mail
from termloom.functions.html import html_paragraph_text, unescape
from termloom.operators import parse
from termloom.sources import emails_tsv, mbox

QUOTED = "word1\n> word2\n>> word3\nword4\n>tight"
HEADER = "line1\r On Wed, Jan 17, 2018 at 9:30 AM, Ann Oth er <ann@example.com> wrote:"


def test_quoted_lines(one):
    assert one(clean.strip_quoted_text("t"), t=QUOTED) == "word1\n\n\nword4\n>tight"


def test_quote_header(one):
    out = one(clean.strip_quote_header("t"), t=HEADER)
    assert "line1" in out and "example.com" not in out
    no_blank = "On Thu, Feb 08, 2018 at 7:45 PM, B <b@c.d>wrote:\nrest"
    assert one(clean.strip_quote_header("t"), t=no_blank) == no_blank
    assert one(clean.strip_quote_header("t", lenient=True), t=no_blank) == "\nrest"


def test_escaping(one):
    text = "a\r\nb\rc\nd\te"
    assert one(clean.escape_content("t"), t=text) == "a\\nb\\nc\\nd\\te"
    assert one(clean.unescape_content("t"), t="a\\nb\\tc") == "a\nb\tc"
    assert one(clean.unescape_content("t", unescape_tabs=False), t="a\\nb\\tc") == "a\nb\\tc"
    assert one(clean.normalize_email("t"), t="\t Ann@Example.COM\r") == "ann@example.com"


@pytest.mark.parametrize(
    "creator,author,address",
    [
        ("Ann Other <ann@x.org>", "Ann Other", "ann@x.org"),
        ("ann@x.org", "", "ann@x.org"),
        ("nobody", "", ""),
        ("", "", ""),
        ("<ann@x.org>", "", "ann@x.org"),
    ],
)
def test_split_address(one, creator, author, address):
    assert one(mail.author_of("t"), t=creator) == author
    assert one(mail.address_of("t"), t=creator) == address


def test_author_can_keep_its_blank(one):
    assert one(mail.author_of("t", trim=False), t="Ann Other <ann@x.org>") == "Ann Other "


@pytest.mark.parametrize(
    "header,display",
    [
        ('"Other, Ann" <ann@x.org>', "Other, Ann <ann@x.org>"),
        ("Ann <ann@x.org>, Bob <b@x.org>", "Ann <ann@x.org>"),
        ("ann@x.org (Ann Other)", "ann@x.org"),
        ("<ann@x.org>", "ann@x.org"),
        ("<ann at x.org>", "ann at x.org"),
        ("nobody", "nobody"),
    ],
)
def test_from_display(one, header, display):
    assert one(mail.from_display("t"), t=header) == display


LISTS = [
    ('"B, C" <b@x.org>, d@x.org ,, list', ["B, C <b@x.org>", "d@x.org", "list"]),
    ("", []),
    ("friends: a@b.c, Dee <d@e.f>;, z@z.z", ["friends: a@b.c, d@e.f;", "z@z.z"]),
    ("nobody:;", ["nobody:;"]),
    (r'"A \" , B" <a@b.c>', ['A " , B <a@b.c>']),
    ("Ann (the (real), one) <a@b.c>, b@c.d (x, y)", ["Ann <a@b.c>", "b@c.d"]),
    (r"Ann (a \) b) <a@b.c>", ["Ann <a@b.c>"]),
    ('(don"t) <a@b.c>, e@f.g', ["a@b.c", "e@f.g"]),
    ("<@h.i,@j.k:a@b.c>", ["a@b.c"]),
    ('<"a, >b"@c.d>', ['"a, >b"@c.d']),
    # no lists: open quotation, comment, bracket, group
    ('"A, <a@b.c>, d@e.f', ['"A', "<a@b.c>", "d@e.f"]),
    ("(A, a@b.c", ["(A", "a@b.c"]),
    ("A <a@b.c, d@e.f", ["A <a@b.c", "d@e.f"]),
    ("friends: a@b.c, d@e.f", ["friends: a@b.c", "d@e.f"]),
]


@pytest.mark.parametrize("header,entries", LISTS)
def test_recipients(one, header, entries):
    assert one(mail.recipients("t"), t=header) == entries


@pytest.mark.parametrize(
    "header,display",
    [
        ("team: Ann <a@b.c>, d@e.f;", "Ann <a@b.c>"),
        (r'"Ann \"A\" B" <a@b.c>', 'Ann "A" B <a@b.c>'),
        ("Ann (a (b)) <a@b.c>", "Ann <a@b.c>"),
        (", ,b@c.d", "b@c.d"),
        ("none:;", ""),
    ],
)
def test_from_grammar(one, header, display):
    assert one(mail.from_display("t"), t=header) == display


def test_creators_are_split_as_by_the_patterns(spark):
    """The forms are ``(.*)<(.+@.+)>`` and ``(.+@.+)``, over the whole text."""
    rng = random.Random(3)
    creators = ["".join(rng.choice("<>@a b") for _ in range(rng.randrange(12))) for _ in range(3_000)]
    df = spark.createDataFrame([(c,) for c in creators], "t string")
    for r in df.select("t", mail.author_of("t", trim=False).alias("author"), mail.address_of("t").alias("address")).collect():
        full, bare = re.fullmatch("(.*)<(.+@.+)>", r.t), re.fullmatch(".+@.+", r.t)
        assert (r.author, r.address) == (full.groups() if full else ("", r.t if bare else "")), r.t


@pytest.mark.parametrize("sign", ["x", "x ", '\\"', "<@", "@<", "(", '"', "a@b.c,", "a:b;", "\\\\"])
def test_headers_of_a_million_signs(one, sign):
    long = sign * (1_000_000 // len(sign))
    quoted = long.replace("\\", "").replace('"', "").strip()
    mailbox = f'"{quoted}" <a@b.c>'
    assert one(mail.from_display("t"), t=mailbox) == (f"{quoted} <a@b.c>" if quoted else "a@b.c")
    assert one(mail.address_of("t"), t=mailbox) == "a@b.c"
    one(mail.author_of("t"), t=long + ">")
    one(F.size(mail.recipients("t")), t=long)
    one(mail.from_display("t"), t=long)
    one(mail.mail_date("t"), t=long)


def test_messages_with_long_headers(spark):
    long = '"' + 'very \\" long, ' * 80_000 + '"'
    message = f"From x\nFrom: {long} <a@b.c>\nTo: {long} <t@o.x>, u@o.x\nSubject: {long}\nDate: {long}\n\nbody\n"
    row = parse.parse_messages(spark.createDataFrame([(message,)], "message string")).first()
    name = long[1:-1].replace("\\", "")
    assert (row.author, row.email) == (name.strip(), "a@b.c")
    assert row.to == [f"{name.strip()} <t@o.x>", "u@o.x"] and row.content == "body\n"


def test_names_are_decoded_after_lists_are_taken_apart(spark):
    message = (
        "From x\nFrom: =?utf-8?q?Doe=2C_Jan=C3=A9?= <j@x.org>\n"
        "To: =?utf-8?b?w4Us?= <a@x.org>, team: =?utf-8?q?B?= <b@x.org>;\n\nbody\n"
    )
    row = parse.parse_messages(spark.createDataFrame([(message,)], "message string")).first()
    assert (row.author, row.email) == ("Doe, Jané", "j@x.org")
    assert row.to == ["Å, <a@x.org>", "team: b@x.org;"]


@pytest.mark.parametrize(
    "header,utc",
    [
        ("Fri, 31 May 2013 16:00:00 -0700", (2013, 5, 31, 23, 0, 0)),
        ("31 May 2013 16:00:00 GMT", (2013, 5, 31, 16, 0, 0)),
        ("Fri,31 May 2013 6:00:01 +0000 (UTC)", (2013, 5, 31, 6, 0, 1)),
        ("Fri,  1 May 13 16:00 EST", (2013, 5, 1, 21, 0, 0)),
        ("yesterday", None),
        ("", None),
    ],
)
def test_mail_date(one, header, utc):
    got = one(F.date_format(mail.mail_date("t"), "yyyy-MM-dd HH:mm:ss"), t=header)
    assert got == (utc and dt.datetime(*utc).strftime("%Y-%m-%d %H:%M:%S"))


FIRST = (
    "From ann@x.org Fri May 31 16:00:00 2013\n"
    "Message-ID: <1@x>\nfrom: =?utf-8?q?Ann_=C3=89?= <ann@x.org>\nSUBJECT: a\n\tlong  one\nSubject: second\n"
    "Date: Thu, 30 May 2013 16:00:00 +0000\nDate: Fri, 31 May 2013 16:00:00 +0000\n\nSubject: in body\n\nbye\n"
)
MIME = (
    'From b@x.org\nMessage-ID: <2@x>\nContent-Type: multipart/mixed; boundary="b"\n\n--b\nContent-Type: text/plain\n'
    "Content-Transfer-Encoding: quoted-printable\nSubject: inner\n\nna=C3=AFve\n--b\nContent-Type: text/html\n\n"
    "<div>nav</div><p>one<br/>two &amp; <b>three</b></p>\n--b\nContent-Type: image/png\n"
    "Content-Transfer-Encoding: base64\n\nAAAA\n--b--\n"
)


def test_parse_messages(spark):
    raw = spark.createDataFrame([(1, FIRST), (2, MIME), (3, "\nonly body"), (4, "Subject: x")], "n int, message string")
    rows = {r.n: r for r in parse.parse_messages(raw).collect()}
    first = rows[1]
    assert (first.id, first.author, first.email) == ("<1@x>", "Ann É", "ann@x.org")
    assert first.subject == "a long  one" and first.replyid == ""
    assert first.date == dt.datetime(2013, 5, 31, 16, 0, 0)
    assert first.content == "Subject: in body\n\nbye\n"
    # headers of parts are not headers of the message
    assert rows[2].subject == "" and rows[2].content == "naïve\nnav  \none\ntwo & three \n"
    assert (rows[3].subject, rows[3].content) == ("", "only body")
    assert (rows[4].subject, rows[4].content) == ("x", "")


def test_long_lines_are_rejected_and_counted(spark):
    raw = spark.createDataFrame([("Subject: a\n\n" + "x" * 200,), ("Subject: b\n\nshort",)], "message string")
    messages, seen = parse.with_parse_metrics(parse.parse_messages(raw, max_line_len=100))
    assert [r.subject for r in parse.parsed(messages).collect()] == ["b"]
    assert [r.parse_error for r in parse.rejected(messages).collect()] == ["line too long"]
    assert messages.count() == 2 and seen.get["n_messages"] >= 1


def test_long_folded_headers_are_rejected(spark):
    raw = spark.createDataFrame([("Subject: a\n" + " more and more\n" * 20 + "\nbody",)], "message string")
    assert [r.parse_error for r in parse.parse_messages(raw, max_line_len=100).collect()] == ["line too long"]


def archive_text(n):
    return "".join(
        f"From u{i}@x.org Fri May 31 16:00:00 2013\nMessage-ID: <{i}>\n\nbody {i}\nFromage\n From here\n\n" for i in range(n)
    )


def test_scan_does_not_depend_on_the_block_size(spark, tmp_path):
    (tmp_path / "a.mbox").write_text(archive_text(2000))
    expected = [m + "\n" for m in ("\n" + archive_text(2000)).rstrip("\n").split("\nFrom u")[1:]]
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("134217728", "20000", "3001"):
            spark.conf.set(key, size)
            scanned = mbox.scan_mbox(spark, str(tmp_path))
            rows = scanned.orderBy("path", "block_start", "seq").collect()
            assert len(rows) == 2000
            assert all(r.message.startswith("From u") for r in rows)
            ids = [int(r.message.split("<")[1].split(">")[0]) for r in rows]
            assert ids == list(range(2000))
            assert {r.message.rstrip("\n") for r in rows} == {("From u" + e).rstrip("\n") for e in expected}
    finally:
        spark.conf.set(key, before)


def test_scan_of_odd_files(spark, tmp_path):
    (tmp_path / "bare.mbox").write_text("Subject: bare\n\nno divider\n")
    (tmp_path / "crlf.mbox").write_bytes(b"From a\r\nSubject: x\r\n\r\none\r\nFrom b\r\nSubject: y\r\n\r\ntwo")
    (tmp_path / "empty.mbox").write_text("")
    got = {r.message for r in mbox.scan_mbox(spark, str(tmp_path)).collect()}
    assert got == {
        "Subject: bare\n\nno divider\n",
        "From a\nSubject: x\n\none\n",
        "From b\nSubject: y\n\ntwo\n",
    }


def test_records_do_not_depend_on_the_block_size(spark, tmp_path):
    head = "hello first line\nsecond line\n"
    body = "From a{i}\nSubject: x\n\nbody {i}\nFrom Subject: y{i}\nrest\n\n"
    text = head + "\n" + "".join(body.format(i=i) for i in range(300))
    (tmp_path / "lf.mbox").write_text(text)
    (tmp_path / "crlf.mbox").write_bytes(text.replace("\n", "\r\n").encode())
    key = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(key)
    try:
        for size in ("134217728", "5000", "61"):
            spark.conf.set(key, size)
            for name in ("lf", "crlf"):
                path = f"{tmp_path}/{name}.mbox"
                plain = [r.message for r in mbox.scan_mbox(spark, path).orderBy("block_start", "seq").collect()]
                assert plain[0] == head and len(plain) == 601
                assert plain[1:3] == ["From a0\nSubject: x\n\nbody 0\n", "From Subject: y0\nrest\n"]
                strict = [r.message for r in mbox.scan_mbox(spark, path, strict=True).orderBy("block_start", "seq").collect()]
                assert strict == [head] + [body.format(i=i).rstrip("\n") + "\n" for i in range(300)]
    finally:
        spark.conf.set(key, before)


def test_charsets(spark):
    def message(charset, raw, coding="8bit"):
        head = f"From x\nSubject: é\nContent-Type: text/plain; charset={charset}\nContent-Transfer-Encoding: {coding}\n\n"
        return head.encode() + raw

    cases = [
        (message("utf-8", "café €".encode()), "café €"),
        (message('"ISO-8859-1"', "café".encode("latin-1")), "café"),
        (message("windows-1252", "café €".encode("cp1252")), "café €"),
        (message("koi8-r", "мир".encode("koi8-r")), "мир"),
        (message("nonsense", "café".encode()), "café"),
        (message("utf-8", b"caf\xe9"), "caf\ufffd"),
        (message("iso-8859-1", b"caf=E9", "quoted-printable"), "café"),
        (message("windows-1252", b"Y2Fm6YA=", "base64"), "café€"),
        (b"From x\nSubject: \xc3\xa9\n\ncaf\xc3\xa9", "café"),
    ]
    raw = spark.createDataFrame([(i, bytearray(m)) for i, (m, _) in enumerate(cases)], "n int, message binary")
    rows = {r.n: r for r in parse.parse_messages(raw).collect()}
    assert {n: r.content for n, r in rows.items()} == {i: want for i, (_, want) in enumerate(cases)}
    assert {r.subject for r in rows.values()} == {"é"}


@pytest.mark.parametrize(
    ("markup", "page", "part"),
    [
        ("<p>one<p>two", "one \ntwo \n", "one \ntwo \n"),
        ("<div><p>in</div>out<p>x</p>y", "in \nx \n", "in \nx \n"),
        ("<div>a</div><div>b</div>", "", "a b  \n"),
        ("before<p>one</p>after<p>two", "one \ntwo \n", "before \none \ntwo \n"),
        ("up to</p>after", "", "up to \n"),
        ("<p>a<br>b<q>c</q><b>d</b>", "a\nbd \n", "a\nbd \n"),
        ("  <P class='x'>caf&eacute; &#8217;&#x41; &amp;lt;</P >", "café ’A &lt; \n", "café ’A &lt; \n"),
    ],
)
def test_paragraphs(one, markup, page, part):
    assert one(html_paragraph_text(F.col("h")), h=markup) == page
    assert one(html_paragraph_text(F.col("h"), part=True), h=markup) == part


@pytest.mark.parametrize(
    ("markup", "page"),
    [
        ("<p>x < 5 and y > 3 fine", "x < 5 and y > 3 fine \n"),
        ("<p>one \x01two \x02three</p>", "one \x01two \x02three \n"),
        ('<p>see <a title="a>b" href=x>here</a></p>', "see here \n"),
        ("<p title='</p>'>in</p>", "in \n"),
        ("<p title=it's>one</p> no <p>two's", "one \ntwo's \n"),
        ("<p>a</p><script>if (a<b) '<p>no</p>'", "a \n"),
        ("<p>a<script>'</p>'; x</scripty></SCRIPT >b</p>", "ab \n"),
        ("<p>a<style>p > b { }</style>b<iframe><p>no</iframe>c", "abc \n"),
        ("<p>a<!-- <p>no > --> b<!-->c<!DOCTYPE x><?php 1 ?>d</p>", "a bcd \n"),
        ("<p>a</ b>c</>d<3 &lt;p&gt; &am<b></b>p;", "acd<3 <p> &amp; \n"),
        ("<p>end<b", "end \n"),
        ("<p>end</p", "end \n"),
        ("<p>a<q>b<p>c</q>d", "a \nd \n"),
        ("<p>a<q>b<q>c</q>d</q>e<br/>f<BR>g", "ade\nf\ng \n"),
        ("<p>a<q>to the end", "a \n"),
        ("<pre>no</pre><P\n>yes</P\n>", "yes \n"),
    ],
)
def test_tokens_of_markup(one, markup, page):
    assert one(html_paragraph_text(F.col("h")), h=markup) == page


@pytest.mark.parametrize("sign", ["<", "<p>", "<!--", "<a b='", '="', "&", "</", "<q>", "<script>", "-", "x"])
def test_long_markup(one, sign):
    one(html_paragraph_text(F.col("h")), h="<p>" + sign * (300_000 // len(sign)))


def test_character_references(one):
    for text in ("&amp;amp;", "&copy &copy;x &copy", "&#0; &#128; &#xD800; &#x110000; &#x1F600;", "a & b && &;"):
        assert one(unescape(F.col("t")), t=text) == html.unescape(text)
    assert one(unescape(F.col("t")), t="&nosuch;") == "&nosuch;"


def test_divider_inside_a_body(spark, tmp_path):
    (tmp_path / "a.mbox").write_text("From a\n\nx\nFrom here on\ny\n\nFrom b\n\nz\n")
    assert mbox.scan_mbox(spark, str(tmp_path)).count() == 3
    assert mbox.scan_mbox(spark, str(tmp_path), strict=True).count() == 2


def test_file_list(spark, tmp_path):
    (tmp_path / "a").write_text(archive_text(3))
    (tmp_path / "b").write_text(archive_text(2))
    (tmp_path / "list.txt").write_text(f"{tmp_path}/a\n{tmp_path}/b\n")
    assert mbox.scan_mbox_list(spark, str(tmp_path / "list.txt")).count() == 5


def test_split_mbox_keeps_text_before_the_first_divider(spark):
    df = spark.createDataFrame([("k", "head\n\nFrom a\nx\nFrom b\ny"), ("e", "")], "k string, t string")
    got = [(r.k, r.seq, r.message) for r in mbox.split_mbox(df, "t").orderBy("k", "seq").collect()]
    assert got == [("k", 0, "head\n"), ("k", 1, "From a\nx\n"), ("k", 2, "From b\ny\n")]


def test_lines_need_seven_fields(spark):
    lines = spark.createDataFrame([("1\ta\t A@X \ts\td\tr\tone\\ntwo",), ("bad\tline",)], "value string")
    ok = emails_tsv.parse_email_lines(lines, mode="permissive").collect()
    assert [tuple(r) for r in ok] == [("a@x", "one\ntwo")]
    assert [r.n_fields for r in emails_tsv.rejected_lines(lines).collect()] == [2]
    blank = spark.createDataFrame([("1\ta\t \ts\td\tr\ttext",)], "value string")
    assert emails_tsv.parse_email_lines(blank).count() == 1
    assert emails_tsv.parse_email_lines(blank, drop_blank=True).count() == 0
    with pytest.raises(Exception, match="Invalid input line"):
        emails_tsv.parse_email_lines(lines).collect()


def test_missing_input_fails_before_it_runs(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        emails_tsv.read_emails_tsv(spark, str(tmp_path / "absent"))


def test_messages_stay_in_the_jvm_while_they_are_scanned(spark, tmp_path):
    (tmp_path / "a.mbox").write_text("\nFrom b\n\none\nFrom c\n\ntwo\n")
    (tmp_path / "b.mbox").write_text("From From d\n\none\nFrom From e\n\ntwo\n")
    scanned = mbox.scan_mbox(spark, str(tmp_path))
    # a blank first record is looked at before it is left out
    assert {r.message for r in scanned.collect()} == {
        "From b\n\none\n", "From c\n\ntwo\n", "From From d\n\none\n", "From From e\n\ntwo\n",
    }
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "_is_first(path" in plan
