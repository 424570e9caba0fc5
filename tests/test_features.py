import math
import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from termloom.functions.analysis import analyze
from termloom.functions.tokens import tokenize
from termloom.functions.parsers import register_parsers
from termloom.operators import frequency, increments, llr, oversize, rank, sketches, terms
from termloom.plans.mine_stopwords import mine_stopwords, mine_stopwords_of
from termloom.plans.parse_archives import parse_archives
from termloom.plans.top_terms import top_terms, top_terms_of
from termloom.sources import wordlists
from termloom.staging import job_folder, new_path, shared_dir, stage
from termloom.sources.mbox import scan_mbox
from termloom.streaming.emails import stream_emails_tsv
from termloom.streaming.mbox import stream_mbox, streamed
from termloom.streaming.oversize import stream_kept_sizes


def g2(k11, row, col, n):
    table = [(k11, row, col), (row - k11, row, n - col), (col - k11, n - row, col), (n - row - col + k11, n - row, n - col)]
    return 2 * sum(k * math.log(k * n / (r * c)) for k, r, c in table if k > 0)


def brute_scores(pairs):
    k = Counter(pairs)
    row, col = Counter(t for _, t in pairs), Counter(u for u, _ in pairs)
    return {(u, t): g2(c, row[t], col[u], len(pairs)) for (u, t), c in k.items()}


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(7)
    # one user has half of the occurrences, one term is used by everybody
    users = ["hot"] * 500 + [f"u{rng.randrange(12)}" for _ in range(500)]
    return [(u, "common" if rng.random() < 0.3 else f"t{rng.randrange(60)}") for u in users]


@pytest.fixture(scope="module")
def occurrences(spark, pairs):
    return spark.createDataFrame(pairs, "email string, term string")


def as_dict(df):
    return {(r.email, r.term): r.score for r in df.collect()}


def test_scores(occurrences, pairs):
    got = as_dict(llr.llr_scores(llr.term_counts(occurrences)))
    want = brute_scores(pairs)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)
    assert all(v > -1e-9 for v in got.values())


def test_hot_keys_in_pieces_give_the_same_scores(occurrences, pairs):
    scored = llr.llr_scores(llr.term_counts(occurrences), share=50, piece_rows=2)
    assert "_piece" in scored._jdf.queryExecution().optimizedPlan().toString()
    got, want = as_dict(scored), brute_scores(pairs)
    assert got.keys() == want.keys()
    assert all(math.isclose(got[k], want[k], rel_tol=1e-9, abs_tol=1e-9) for k in want)


@pytest.mark.parametrize(
    ("table", "score"),
    [((12, 10**7, 10**7, 2 * 10**13), 7.0113), ((3, 2 * 10**6, 2 * 10**7, 2 * 10**13), 0.4328)],
)
def test_scores_of_large_tables_keep_their_digits(one, table, score):
    got = one(llr.g2(*[F.lit(x).cast("bigint") for x in table]))
    assert round(got, 4) == score


def test_score_is_symmetric():
    assert math.isclose(g2(3, 10, 20, 100), g2(3, 20, 10, 100))


def test_only_over_used_terms(occurrences, pairs):
    k, n = Counter(pairs), len(pairs)
    row, col = Counter(t for _, t in pairs), Counter(u for u, _ in pairs)
    over = {(u, t) for (u, t), c in k.items() if c * n > row[t] * col[u]}
    assert as_dict(llr.llr_scores(llr.term_counts(occurrences), direction="over")).keys() == over
    with pytest.raises(ValueError):
        llr.llr_scores(occurrences, direction="under")


@pytest.mark.parametrize("n,threshold", [(3, "1000"), (5, "2")])
def test_top_terms_per_user(spark, occurrences, pairs, n, threshold):
    key = "spark.sql.optimizer.windowGroupLimitThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, threshold)
    try:
        got = llr.top_terms_by_llr(llr.term_counts(occurrences), max_terms=n).collect()
    finally:
        spark.conf.set(key, before)
    want = {}
    for (u, t), s in brute_scores(pairs).items():
        if s >= 1.0:
            want.setdefault(u, []).append((-s, t))
    expected = {(u, t) for u, ts in want.items() for _, t in sorted(ts)[:n]}
    assert {(r.email, r.term) for r in got} == expected


def test_filters_of_the_caller(occurrences):
    counts = llr.term_counts(occurrences)
    assert llr.top_terms_by_llr(counts, min_score=1e9).count() == 0
    only = llr.top_terms_by_llr(counts, min_score=0.0, predicate=F.col("term") == "common")
    assert {r.term for r in only.collect()} == {"common"}


def test_nesting_and_flattening(occurrences):
    top = stage(llr.top_terms_by_llr(llr.term_counts(occurrences), max_terms=4), "test")
    nested = rank.nest_terms(top)
    for row in nested.collect():
        assert row.scores == sorted(row.scores, reverse=True) and len(row.terms) == len(row.scores)
    assert as_dict(rank.flatten_terms(nested)) == as_dict(top)
    ordered = [(r.email, r.score) for r in rank.sort_terms(top).collect()]
    assert ordered == sorted(ordered, reverse=True)


def test_document_frequency_counts_users_without_terms(spark):
    docs = spark.createDataFrame(
        [("a", "apple pear"), ("a", "apple"), ("b", "apple plum"), ("c", "1 2 3"), ("d", None), ("e", "")],
        "email string, content string",
    )
    got = {r.term: r.df for r in mine_stopwords_of(docs, stem=False).collect()}
    assert got == {"apple": 0.4, "pear": 0.2, "plum": 0.2}
    assert frequency.total_docs(docs).first().total_docs == 5
    # exactly one fifth is not more than 0.2, unless single precision is asked for
    assert {r.term for r in mine_stopwords_of(docs, max_df=0.2, stem=False).collect()} == {"apple"}
    single = mine_stopwords_of(docs, max_df=0.2, stem=False, float32=True)
    assert {r.term for r in single.collect()} == {"apple", "pear", "plum"}


def test_approximate_counts_are_close(occurrences):
    exact = {r.term: r.doc_count for r in frequency.unique_count(occurrences).collect()}
    approx = {r.term: r.doc_count for r in frequency.unique_count(occurrences, approx=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[t] - approx[t]) <= 0.2 * exact[t] + 1 for t in exact)


@pytest.mark.parametrize("size", [1, 2, 3])
@pytest.mark.parametrize("piece", [3, 7, 1000])
def test_pieces_of_a_text_give_the_terms_of_the_whole(spark, monkeypatch, size, piece):
    monkeypatch.setattr(terms, "PIECE_WORDS", piece)
    rng = random.Random(3)
    words = ["alpha", "beta", "gamma", "it", "the", "delta", "42"]
    texts = [(f"u{i}", " ".join(rng.choices(words, k=n))) for i, n in enumerate([0, 1, 2, 3, 6, 7, 8, 14, 40])]
    docs = spark.createDataFrame(texts, "email string, content string")
    whole = docs.select("email", F.explode(analyze("content", shingle_size=size, stopwords=["the"], stem=False)).alias("t"))
    parts = terms.user_terms(docs, shingle_size=size, stopwords=["the"], stem=False)
    assert Counter(map(tuple, parts.collect())) == Counter(map(tuple, whole.collect()))


def test_own_analyzer(spark):
    docs = spark.createDataFrame([("a", "x y"), ("b", "x")], "email string, content string")
    rows = terms.user_terms(docs, analyzer=lambda c: F.split(c, " "))
    assert sorted(map(tuple, rows.collect())) == [("a", "x"), ("a", "y"), ("b", "x")]
    top = top_terms_of(docs, analyzer=tokenize, min_score=0.0)
    assert {(r.email, r.term) for r in top.collect()} == {("a", "x"), ("a", "y"), ("b", "x")}


def running_rule(sizes):
    kept, total = [], 0
    for i, size in enumerate(sizes, 1):
        total += size or 0
        if not (i > 100 and (size or 0) > 4 * total // i):
            kept.append(i)
    return kept


@pytest.mark.parametrize("chunk", [1, 7, 1000])
def test_running_length_rule(spark, chunk):
    rng = random.Random(5)
    files = {"a": 400, "b": 130, "c": 90}
    rows = [(p, i, rng.choice([1, 5, 9, None, 400])) for p, n in files.items() for i in range(1, n + 1)]
    df = spark.createDataFrame(rows, "path string, seq int, size int").repartition(3)
    df = df.withColumn("block_start", F.floor(F.col("seq") / chunk))
    kept = oversize.skip_oversized_running(df, F.col("size"), ["path"], ["block_start"], ["seq"])
    got = {p: sorted(r.seq for r in kept.filter(F.col("path") == p).collect()) for p in files}
    assert got == {p: running_rule([s for q, _, s in rows if q == p]) for p in files}


def test_global_length_rule(spark):
    sizes = [10] * 100 + [43, 44, 60]
    df = spark.createDataFrame([(s,) for s in sizes], "size int")
    limit = 4 * sum(sizes) // len(sizes)
    kept = oversize.skip_oversized_global(df, F.col("size"))
    assert sorted(r.size for r in kept.collect()) == [s for s in sizes if s <= limit]
    assert oversize.skip_oversized_global(df.filter("size > 40"), F.col("size")).count() == 3


def test_stopword_lists(spark, tmp_path):
    (tmp_path / "stop.txt").write_text("the\n# kept\n  padded\nthe\n")
    got = wordlists.read_stopwords(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.term for r in got.collect()) == ["  padded", "# kept", "the"]
    assert wordlists.read_stopwords(spark, None).count() == 0
    listed = wordlists.read_wordlist(spark, str(tmp_path / "stop.txt"))
    assert sorted(r.term for r in listed.collect()) == ["padded", "the"]


def test_exclusion_by_table(spark, occurrences):
    left = terms.drop_stopwords(occurrences, spark.createDataFrame([("common",)], "term string"))
    assert left.columns == occurrences.columns
    assert left.filter("term = 'common'").count() == 0
    assert left.count() == occurrences.filter("term <> 'common'").count()


def test_stop_words_as_a_table(spark):
    docs = spark.createDataFrame([("a", "red apples fall"), ("b", "red pears")], "email string, content string")
    listed = spark.createDataFrame([("red",)], "term string")
    for size in (1, 2):
        by_table = top_terms_of(docs, stopwords=listed, shingle_size=size, min_score=0.0).collect()
        by_list = top_terms_of(docs, stopwords=["red"], shingle_size=size, min_score=0.0).collect()
        assert by_table == by_list and "red" not in {r.term for r in by_table}


def test_staged_tables_live_in_the_shared_folder(spark, occurrences):
    assert new_path(spark, "x") != new_path(spark, "x")
    staged = stage(occurrences, "pairs")
    files = staged.inputFiles()
    assert files and all(shared_dir(spark) in f for f in files)
    assert staged.schema == occurrences.schema and staged.count() == occurrences.count()


def message(i, user, body):
    return (
        f"From {user} Fri May 31 16:00:00 2013\nMessage-ID: <{i}@x>\nFrom: {user.title()} <{user}@X.org>\n"
        f"Subject: s{i}\nDate: Fri, 31 May 2013 16:00:00 +0000\n\n{body}\n\n"
    )


def test_jobs_from_archive_to_terms(spark, tmp_path):
    bodies = {"ann": "apples are red apples", "bob": "boats and boats", "cid": "red boats\tor apples"}
    text = "".join(message(f"{u}{i}", u, b) for i in range(40) for u, b in bodies.items())
    (tmp_path / "mail.mbox").write_text(text + message("big", "ann", "apples " * 2000))
    (tmp_path / "files.txt").write_text(f"{tmp_path}/mail.mbox\n")
    staged = os.path.join(shared_dir(spark), "termloom", spark.sparkContext.applicationId)
    before = set(os.listdir(staged)) if os.path.exists(staged) else set()
    counts = parse_archives(
        spark, f"{tmp_path}/emails", f"{tmp_path}/files.txt", oversize="global", rejects_dir=f"{tmp_path}/rejects"
    )
    assert counts == {"n_messages": 121, "n_rejected": 0, "n_skipped": 1}
    skipped = spark.read.parquet(f"{tmp_path}/rejects").collect()
    assert [(r.id, r.parse_error) for r in skipped] == [("<annbig@x>".replace("ann", ""), "longer than four times the mean")]
    lines = [r.value.split("\t") for r in spark.read.text(f"{tmp_path}/emails").collect()]
    assert len(lines) == 120 and all(len(f) == 7 for f in lines)
    assert ["<ann0@x>", "Ann", "ann@X.org", "sann0", "2013-05-31T16:00:00Z", ""] in [f[:6] for f in lines]

    (tmp_path / "stop.txt").write_text("red\n")
    out = top_terms(spark, f"{tmp_path}/emails", f"{tmp_path}/work", f"{tmp_path}/stop.txt", max_terms=2)
    best = {}
    for r in spark.read.parquet(out).orderBy(F.desc("score")).collect():
        best.setdefault(r.email, r.term)
    assert best["ann@x.org"] in ("appl", "boat") and best["bob@x.org"] == "and"
    assert "red" not in {r.term for r in spark.read.parquet(out).collect()}

    out = mine_stopwords(spark, f"{tmp_path}/emails", f"{tmp_path}/work", max_df=0.5)
    assert {(r.term, round(r.df, 4)) for r in spark.read.parquet(out).collect()} == {
        ("appl", 0.6667), ("boat", 0.6667), ("red", 0.6667),
    }
    # a second run replaces the first
    out = mine_stopwords(spark, f"{tmp_path}/emails", f"{tmp_path}/work", fmt="tsv")
    assert {r.value.split("\t")[0] for r in spark.read.text(out).collect()} == {"appl", "boat", "red", "and"}

    kept = parse_archives(spark, f"{tmp_path}/all", paths=f"{tmp_path}/mail.mbox", oversize="running", fmt="parquet")
    assert kept["n_messages"] == 121 and spark.read.parquet(f"{tmp_path}/all").count() == 120
    assert parse_archives(spark, f"{tmp_path}/every", paths=f"{tmp_path}/mail.mbox")["n_skipped"] == 0
    assert spark.read.text(f"{tmp_path}/every").count() == 121
    # jobs leave nothing in the shared folder
    assert (set(os.listdir(staged)) if os.path.exists(staged) else set()) == before
    with pytest.raises(ValueError):
        parse_archives(spark, f"{tmp_path}/none")


def test_arriving_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.tsv").write_text("1\ta\tA@X\ts\td\tr\tred apples\nbroken\n")
    docs = stream_emails_tsv(spark, str(tmp_path / "in"))
    rows = terms.user_terms(docs)
    run = (
        rows.writeStream.format("memory").queryName("arriving")
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    run.awaitTermination(120)
    assert sorted(map(tuple, spark.table("arriving").collect())) == [("a@x", "appl"), ("a@x", "red")]


class _Session:
    """Just what the choice of the shared folder looks at."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{id(self)}"})


def test_choice_of_the_shared_folder():
    assert shared_dir(_Session("spark://x", {"spark.checkpoint.dir": "hdfs:///cp/"})) == "hdfs:///cp"
    for master in ("local[2]", "spark://x"):
        with pytest.raises(ValueError):
            shared_dir(_Session(master, {}))


def test_rejected_messages_do_not_move_the_mean(spark, tmp_path):
    """A message is too long by the length of those that could be parsed, in both modes."""
    short = "".join(message(f"{i}", "ann", "a b c d e f") for i in range(150))
    for position, name in ((short + message("big", "ann", "x y " * 16), "end"), (message("w", "ann", "z" * 200_000), "wide")):
        (tmp_path / name).write_text(position)
    text = (tmp_path / "wide").read_text() + (tmp_path / "end").read_text()
    (tmp_path / "mail.mbox").write_text(text)
    for mode in ("global", "running"):
        counts = parse_archives(
            spark, f"{tmp_path}/{mode}", paths=f"{tmp_path}/mail.mbox", oversize=mode, max_line_len=100_000,
            rejects_dir=f"{tmp_path}/{mode}-rejects",
        )
        assert counts == {"n_messages": 152, "n_rejected": 1, "n_skipped": 1}
        assert spark.read.parquet(f"{tmp_path}/{mode}-rejects").count() == 2


def test_stop_words_with_an_own_analyzer(spark):
    docs = spark.createDataFrame([("a", "Red apples fall"), ("b", "red pears")], "email string, content string")
    listed = spark.createDataFrame([("red",)], "term string")
    own = lambda text: F.split(F.lower(text), " ")
    by_table = top_terms_of(docs, stopwords=listed, analyzer=own, min_score=0.0).collect()
    by_list = top_terms_of(docs, stopwords=["red"], analyzer=own, min_score=0.0).collect()
    assert by_table == by_list and {r.term for r in by_table} == {"apples", "fall", "pears"}


def random_counts(spark, n=4_000):
    rng = random.Random(5)
    rows = {(f"u{rng.randrange(12)}", f"t{int(rng.paretovariate(0.7)) % 300}"): int(rng.paretovariate(0.6)) for _ in range(n)}
    return spark.createDataFrame([(u, t, k) for (u, t), k in rows.items()], "email string, term string, k11 long")


def test_bounds_hold_and_prune_nothing_that_counts(spark):
    counts = random_counts(spark)
    whole = {(r.email, r.term): r.score for r in llr.llr_scores(counts).collect()}
    for score in (1.0, 30.0, 1000.0):
        kept = {(r.email, r.term): r.score for r in llr.llr_scores(counts, prune_below=score).collect()}
        assert kept.items() <= whole.items() and (score < 1000 or len(kept) < len(whole))
        assert all(whole[key] < score for key in whole.keys() - kept.keys())
        plain, pruned = (llr.top_terms_by_llr(counts, min_score=score, prune=p).collect() for p in (False, True))
        assert sorted(plain) == sorted(pruned)


def test_scores_are_computed_once(spark):
    top = llr.top_terms_by_llr(random_counts(spark))
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert plan.upper().count("LOG1P(") == 4


def test_bucketed_counts_do_not_move_for_their_term_totals(spark):
    counts = random_counts(spark)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        scores = llr.llr_scores(counts, buckets=4)
        plan = scores._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning(term" not in plan and "hashpartitioning(email" in plan
        assert sorted(scores.collect()) == sorted(llr.llr_scores(counts).collect())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_jobs_drop_their_tables(spark):
    known = len(spark.catalog.listTables())
    with job_folder(spark, "buckets"):
        llr.llr_scores(random_counts(spark, 50), buckets=2).collect()
        assert len(spark.catalog.listTables()) == known + 1
    assert len(spark.catalog.listTables()) == known


def test_length_rule_on_a_stream(spark, tmp_path):
    rng = random.Random(2)
    rows = [(f"g{i % 3}", i, None if i % 50 == 0 else rng.randrange(1, 20) * (40 if i % 37 == 0 else 1)) for i in range(900)]
    schema = "g string, i long, n long"
    source, out, state = (str(tmp_path / name) for name in ("in", "out", "state"))

    def run():
        arriving = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
        kept = stream_kept_sizes(arriving, "g", "i", "n")
        query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", state)
        query.trigger(availableNow=True).start().awaitTermination()

    # two files, a stop, a file that brings some messages a second time
    for lo, hi in [(0, 300), (300, 500)]:
        spark.createDataFrame(rows[lo:hi][::-1], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    spark.createDataFrame(rows[450:], schema).coalesce(1).write.mode("append").parquet(source)
    run()
    got = sorted((r.group, r.place) for r in spark.read.parquet(out).collect())
    whole = spark.createDataFrame(rows, schema).withColumn("chunk", F.floor(F.col("i") / 100))
    want = oversize.skip_oversized_running(whole, F.col("n"), ["g"], ["chunk"], ["i"])
    assert got == sorted((r.g, r.i) for r in want.collect())
    assert len(got) < len(rows)


def test_mbox_stream_survives_a_failure(spark, tmp_path):
    folder, out, state = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "state")
    folder.mkdir()

    def archive(name, n):
        body = "From a\nSubject: {0} {1}\n\nbody\nFrom here on\n\n"
        (folder / name).write_text("".join(body.format(name, i) for i in range(n)))

    for k in range(5):
        archive(f"a{k}", k + 1)
    done = []

    def fails_once(messages):
        done.append(1)
        if len(done) == 3:
            raise RuntimeError("stopped in the middle")
        return messages.select("path", "seq", "message")

    def run():
        stream_mbox(
            spark, str(folder), out, state, strict=True, files_per_batch=2, transform=fails_once, availableNow=True
        ).awaitTermination()

    with pytest.raises(Exception, match="stopped in the middle"):
        run()
    archive("late", 4)
    run()
    run()
    got = Counter(r.message for r in streamed(spark, out).collect())
    want = Counter(r.message for r in scan_mbox(spark, str(folder), strict=True).collect())
    assert got == want and sum(want.values()) == 19


def test_slices_of_counts(spark, tmp_path):
    store = str(tmp_path / "store")
    assert increments.merged_counts(spark, store).count() == 0 and increments.slices(spark, store) == []

    def terms(*pairs):
        return spark.createDataFrame(list(pairs), "email string, term string")

    increments.add_slice(spark, store, "a", terms(("u", "x"), ("u", "x"), ("v", "y")))
    increments.add_slice(spark, store, "b", terms(("u", "x")))
    increments.add_slice(spark, store, "b", terms(("u", "x"), ("w", None)))
    increments.add_slice(spark, store, "none", terms(("u", "x")).filter("false"))
    got = {tuple(r) for r in increments.merged_counts(spark, store).collect()}
    assert got == {("u", "x", 3), ("v", "y", 1), ("w", None, 1)}
    assert increments.slices(spark, store) == ["a", "b", "none"]
    assert {tuple(r) for r in increments.merged_counts(spark, store, ["b"]).collect()} == {("u", "x", 1), ("w", None, 1)}


def test_sketches_merge_and_forget_replays(spark):
    rows = [(f"t{t}", f"u{u}", u % 4) for t, n in enumerate((1, 2, 50, 3_000, 20_000)) for u in range(n)]
    df = spark.createDataFrame(rows, "term string, email string, part int")
    by_part = sketches.user_sketches(df, ["part"])
    merged = sketches.merge_sketches(by_part.union(by_part.filter("part < 2")))
    got = {r.term: r.doc_count for r in sketches.estimated_users(merged).collect()}
    assert (got["t0"], got["t1"], got["t2"]) == (1, 2, 50)
    for term, n in (("t3", 3_000), ("t4", 20_000)):
        assert abs(got[term] / n - 1) < 6 * sketches.relative_error()


class Counted:
    """Numbers the words that one task has seen."""

    def __init__(self, upper=False):
        self.seen, self.upper = 0, upper

    @staticmethod
    def columns(upper=False):
        return StructType().add("word", "string").add("nth", "long")

    def parse(self, text):
        for w in text.split():
            self.seen += 1
            yield (w.upper() if self.upper else w), self.seen


def test_parsers_as_table_functions(spark):
    register_parsers(spark, "parsed_words", {"counted": Counted})
    spark.createDataFrame([(1, "a b"), (2, None), (3, "c")], "i int, t string").coalesce(1).createOrReplaceTempView("texts")
    got = spark.sql("select i, w.* from texts, lateral parsed_words(t, 'counted', '{\"upper\": true}') w").collect()
    assert sorted(map(tuple, got)) == [(1, "A", 1), (1, "B", 2), (3, "C", 3)]
    with pytest.raises(Exception, match="one of counted"):
        spark.sql("select * from texts, lateral parsed_words(t, 'other')").collect()


def test_scores_of_totals_beyond_64_bits(spark):
    # products of 38 digits are made as whole numbers, products of 64 bits as longs, with one result
    n, row, col = 3 * 10**19, 6 * 10**15, 5 * 10**14
    table = spark.range(1).select(*(F.lit(str(x)).cast("decimal(38,0)").alias(k) for k, x in (("n", n), ("r", row), ("c", col))))
    score = table.select(llr.g2(F.lit(150000), F.col("r"), F.col("c"), F.col("n"))).first()[0]
    assert score == pytest.approx(g2(150000, row, col, n), rel=1e-3)
    small = spark.createDataFrame([(3, 5, 7, 100), (5, 5, 7, 100), (7, 7, 7, 7)], "k long, r long, c long, n long")
    found = [x[0] for x in small.select(llr.g2(F.col("k"), F.col("r"), F.col("c"), F.col("n"))).collect()]
    assert found == pytest.approx([g2(3, 5, 7, 100), g2(5, 5, 7, 100), 0.0])
