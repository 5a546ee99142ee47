"""Line, exact, substring and near-duplicate dedup, and sharding, against brute force."""

import random
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import PASSAGE, make, sha
from pyspark.sql import functions as F

from dimwright.llm import exact_dedup, line_dedup, minhash_dedup, sharding, substring_dedup
from dimwright.llm.common import LAST_ID
from dimwright.llm.components import connected_components

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACE:
        text = text.replace(c, " ")
    return [w for w in text.split(" ") if w]


def ranked(rows):
    """(rank, doc_id, text) with the rank that the operators give: null ids last, told apart by text."""
    return [((LAST_ID if i is None else i, t or "" if i is None else ""), i, t or "") for i, t, *_ in rows]


# -- lines ------------------------------------------------------------------------
def brute_lines(rows):
    """Which document keeps a key; a repeated document (same id and text) keeps it in every repeat."""
    rows = ranked(rows)
    owner = {}
    key = lambda line: "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(SPACE))
    for rank, _, text in rows:
        for line in text.split("\n"):
            k = key(line)
            if len(k) >= 10:
                owner[k] = min(owner.get(k, rank), rank)
    out = []
    for rank, doc_id, text in rows:
        lines = text.split("\n")
        kept = [x for x in lines if owner.get(key(x), rank) == rank]
        out.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return sorted(map(str, out))


def line_results(df):
    return sorted(str(tuple(r)[:4]) for r in line_dedup.dedup_lines(df).collect())


@pytest.fixture
def many_partitions(spark):
    """As on a cluster: many shuffle partitions that stay apart, so groups cross partition borders."""
    keep = {"spark.sql.shuffle.partitions": "37", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keep}
    for k, v in keep.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def null_ids_apart(rows):
    """Rows without an id are ordered by a hash of their text; the brute force below needs at most one."""
    seen, out = False, []
    for r in rows:
        if r[0] is None:
            if seen:
                continue
            seen = True
        out.append(r)
    return out


def test_lines(spark, odd_rows, corpus, corpus_rows, none):
    rows = null_ids_apart(odd_rows)
    assert line_results(make(spark, rows)) == brute_lines(rows)
    assert line_results(corpus) == brute_lines(corpus_rows)
    assert line_dedup.dedup_lines(none).count() == 0


def test_lines_shared_by_all_cross_partitions(spark, many_partitions):
    rng = random.Random(5)
    rows = [(i, "\n".join(["the same line everywhere", rng.choice(["short", "another line here", "  THE SAME line everywhere"]),
                           f"own line number {i}", "the same line everywhere"])) for i in range(300)]
    assert line_results(make(spark, rows)) == brute_lines(rows)


def test_two_documents_without_id_keep_one_copy_of_a_line(spark):
    rows = [(None, "first\na line that both documents hold"), (None, "second\na line that both documents hold")]
    got = line_dedup.dedup_lines(make(spark, rows)).collect()
    assert sorted(r.n_dropped for r in got) == [0, 1]


def test_bitmap_round_trip(spark):
    rows = [(1, "line number one\nline number two"), (2, "line number two\nmine alone\nline number one\nlast")]
    got = {r.doc_id: r for r in line_dedup.dedup_lines(make(spark, rows)).collect()}
    assert got[1].keep_bitmap is None
    bits = zlib.decompress(got[2].keep_bitmap)
    assert bits == bytes([0b010])  # lines past the third stay
    assert line_dedup.kept_lines(rows[1][1], 3, got[2].keep_bitmap) == ([b"mine alone", b"last"], 4)


# -- exact ------------------------------------------------------------------------------
def brute_exact(rows):
    groups = defaultdict(list)
    for doc_id, text, *_ in rows:
        groups[text or ""].append(doc_id)
    out = []
    for text, ids in groups.items():
        named = [i for i in ids if i is not None]
        keep = max(named) if named else None
        out += [(i, keep, len(ids), i == keep, sha(text)) for i in ids]
    return sorted(map(str, out))


def exact_results(df, **kw):
    return sorted(str(tuple(r)[:5]) for r in exact_dedup.exact_duplicates(df, **kw).collect())


def test_exact(odd, odd_rows, corpus, corpus_rows, none):
    assert exact_results(odd) == brute_exact(odd_rows)
    assert exact_results(corpus) == brute_exact(corpus_rows)
    assert exact_dedup.exact_duplicates(none).count() == 0


def test_unequal_texts_under_one_digest_are_told_apart(odd, odd_rows):
    weak = lambda text: F.substring(F.sha2(text.cast("binary"), 256), 1, 1)
    assert exact_results(odd, digest=weak) == brute_exact(odd_rows)


def test_state_continues_over_a_grown_log(spark):
    from dimwright.session import work_path

    log, state = work_path(spark, "log"), work_path(spark, "state")
    exact_dedup.digest_log(make(spark, [(1, "a"), (2, "b")])).write.parquet(log)
    first = exact_dedup._groups(exact_dedup.update_state(spark, log, state)).collect()
    exact_dedup.digest_log(make(spark, [(3, "a"), (0, "b")])).write.mode("append").parquet(log)
    then = exact_dedup._groups(exact_dedup.update_state(spark, log, state)).collect()
    assert sorted((r.keep_id, r.group_size) for r in first) == [(1, 1), (2, 1)]
    assert sorted((r.keep_id, r.group_size) for r in then) == [(2, 2), (3, 2)]


def test_drop_exact_keeps_columns(odd, odd_rows):
    out = exact_dedup.drop_exact_duplicates(odd)
    assert out.columns == odd.columns
    ids = Counter(r.doc_id for r in out.collect())
    assert ids[6] == 1 and ids[5] == 0 and ids[3] == 1  # copies go, and rows that repeat id and text


def test_drop_exact_keeps_one_row_of_each_text(spark):
    rows = [(None, "same"), (None, "same"), (None, "same"), (5, "five"), (5, "five"), (4, "five"), (7, "seven"), (7, "own"),
            (None, None), (None, ""), (8, "eight")]
    left = exact_dedup.drop_exact_duplicates(make(spark, rows)).collect()
    assert Counter((r.doc_id, r.text or "") for r in left) == Counter(
        [(None, "same"), (5, "five"), (7, "seven"), (7, "own"), (None, ""), (8, "eight")])


# -- substrings ----------------------------------------------------------------------------
def brute_substrings(rows):
    first, out = {}, []
    for rank, doc_id, text in sorted(ranked(rows), key=lambda r: r[0]):
        words = words_of(text)
        gone = [False] * len(words)
        here = {}
        for i in range(len(words) - 19):
            k = tuple(words[i : i + 20])
            if first.setdefault(k, rank) != rank or here.setdefault(k, i) != i:
                gone[i : i + 20] = [True] * 20
        kept = [w for w, g in zip(words, gone) if not g]
        out.append((doc_id, len(words), len(words) - len(kept), sha(" ".join(kept))))
    return sorted(map(str, out))


def substring_results(df):
    return sorted(str(tuple(r)) for r in substring_dedup.remove_repeats(df).collect())


def test_substrings_of_many_repeated_rows(spark):
    """Phrases are listed once for a document, however often its row is repeated."""
    rng = random.Random(17)
    text = " ".join(f"w{rng.randrange(500)}" for _ in range(400))
    rows = [(1, text)] * 400 + [(2, "before it " + text)] * 3 + [(3, "nothing of it")]
    docs = make(spark, rows)
    assert substring_results(docs) == brute_substrings(rows)


def test_substrings(spark, odd_rows, corpus, corpus_rows, none):
    rows = null_ids_apart(odd_rows)
    assert substring_results(make(spark, rows)) == brute_substrings(rows)
    assert substring_results(corpus) == brute_substrings(corpus_rows)
    assert substring_dedup.remove_repeats(none).count() == 0


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_substrings_overlaps_edges_and_repeats(spark, many_partitions, seed):
    """Few words, so windows overlap, repeat in one document, and end ragged at passage edges."""
    rng = random.Random(seed)
    passages = [[f"w{rng.randrange(6)}" for _ in range(rng.randrange(19, 60))] for _ in range(5)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(4)):
            p = rng.choice(passages)
            a = rng.randrange(3)
            words += p[a : len(p) - rng.randrange(3)] + [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(3))]
        if rng.random() < 0.2:
            words += ["same"] * rng.randrange(15, 50)
        rows.append((i, " ".join(words)))
    assert substring_results(make(spark, rows)) == brute_substrings(rows)


def test_removed_text(spark):
    rows = [(1, "own start " + PASSAGE), (2, "before " + PASSAGE + " after")]
    got = {r.doc_id: r.kept_text for r in substring_dedup.remove_repeats(make(spark, rows), with_text=True).collect()}
    assert got == {1: rows[0][1], 2: "before after"}


# -- near duplicates ---------------------------------------------------------------------------
def brute_near(rows):
    docs = []
    for rank, doc_id, text in ranked(rows):
        words = words_of("".join(c.lower() if "A" <= c <= "Z" else c for c in text))
        size = min(5, len(words))
        docs.append((rank[0], doc_id, {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} if words else set()))
    parent = list(range(len(docs)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    by_shingle = defaultdict(list)
    for i, (_, _, s) in enumerate(docs):
        for x in s:
            by_shingle[x].append(i)
    shared = Counter()
    for members in by_shingle.values():
        if len(members) < 2:
            continue
        for k, i in enumerate(members):
            for j in members[:k]:
                shared[j, i] += 1
    for (i, j), n in shared.items():
        if 100 * n >= 75 * (len(docs[i][2]) + len(docs[j][2]) - n):
            parent[root(i)] = root(j)
    low = {}
    for i, (rank, _, s) in enumerate(docs):
        low[root(i)] = min(low.get(root(i), rank), rank)
    out = []
    for i, (rank, doc_id, s) in enumerate(docs):
        c = low[root(i)] if s else rank
        out.append((doc_id, len(s), None if c == LAST_ID else c, c == rank))
    return sorted(map(str, out))


def near_results(df, **kw):
    return sorted(str(tuple(r)) for r in minhash_dedup.near_duplicates(df, **kw).collect())


def test_near(odd, odd_rows, corpus, corpus_rows, none):
    assert near_results(odd) == brute_near(odd_rows)
    assert near_results(corpus) == brute_near(corpus_rows)
    assert minhash_dedup.near_duplicates(none).count() == 0


def test_near_in_large_and_small_buckets(spark):
    """Families of near copies, chains of edits, and documents that share half of their text but are no copies."""
    rng = random.Random(11)
    vocabulary = [f"v{i}" for i in range(5000)]
    rows, common = [], [rng.choice(vocabulary) for _ in range(60)]
    for family in range(6):
        base = [rng.choice(vocabulary) for _ in range(150)]
        for _ in range(25):
            copy = list(base)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(copy)))
    chain = [rng.choice(vocabulary) for _ in range(200)]
    for _ in range(12):
        chain = chain[8:] + [rng.choice(vocabulary) for _ in range(8)]
        rows.append((len(rows), " ".join(chain)))
    for _ in range(120):
        rows.append((len(rows), " ".join(common + [rng.choice(vocabulary) for _ in range(50)])))
    rng.shuffle(rows)
    want = brute_near(rows)
    assert near_results(make(spark, rows)) == want
    # tiny limits: everything goes through the rounds for large buckets
    few = minhash_dedup.Params(small_bucket=2, hot_share=0.05)
    assert near_results(make(spark, rows), p=few) == want


def half_sharing_family(rng, n=300):
    """Documents that share most of their text but are no copies (0.69), and in pairs a little more of it (0.77)."""
    own = lambda k: [f"x{rng.randrange(10**9)}" for _ in range(k)]
    common, rows = own(168), []
    for _ in range(n // 2):
        pair = own(10)
        rows += [(len(rows) + k, " ".join(common + pair + own(26))) for k in range(2)]
    rng.shuffle(rows)
    return rows


def test_near_pairs_inside_a_large_family(spark):
    """Every bucket of the family is large; the production settings find all pairs in it."""
    rows = half_sharing_family(random.Random(21))
    want = brute_near(rows)
    assert sum(r.endswith("False)") for r in want) == len(rows) // 2
    assert near_results(make(spark, rows)) == want


def test_near_texts_without_id_are_told_apart(spark):
    """Two unlike texts without an id, each near a document of its own or of none; only the near ones go."""
    text = lambda w: " ".join(f"{w}{i}" for i in range(80))
    rows = [(3, text("a")), (None, text("a") + " end"), (None, text("b")), (9, text("c")), (None, text("c") + " end"),
            (None, text("c") + " end"), (None, None), (None, text("d"))]
    docs = make(spark, rows)
    assert near_results(docs) == brute_near(rows)
    left = Counter((r.doc_id, r.text) for r in minhash_dedup.drop_near_duplicates(docs).collect())
    assert left == Counter([rows[k] for k in (0, 2, 3, 6, 7)])


def test_components_of_a_long_chain(spark):
    n = 80
    order = list(range(n))
    random.Random(3).shuffle(order)
    links = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5000, 5000)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(n)} | {1000: 1000, 1001: 1000}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_drop_near_keeps_columns_and_one_of_each(odd, odd_rows):
    out = minhash_dedup.drop_near_duplicates(odd)
    assert out.columns == odd.columns
    ids = {r.doc_id for r in out.collect()}
    assert {1, 2, 3, 5} <= ids and not {6, 9} & ids


# -- sharding -------------------------------------------------------------------------------------
@pytest.mark.parametrize("n", [1, 2, 3, 5, 24, 97, 1000, 4097])
def test_feistel_is_a_permutation(spark, n):
    got = [r.y for r in spark.range(n).select(sharding.feistel(F.col("id"), n, 3).alias("y")).collect()]
    assert sorted(got) == list(range(n))
    assert n < 24 or got != sorted(got)


def check_shards(rows, got, shards=24):
    want = Counter((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    slots = defaultdict(list)
    for r in got:
        assert r.law == "rows" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    sizes = [len(slots[s]) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1


def test_shards(odd, odd_rows, corpus, corpus_rows, none):
    check_shards(odd_rows, sharding.shard_rows(odd).collect())
    check_shards(corpus_rows, sharding.shard_rows(corpus).collect())
    assert sharding.shard_rows(none).count() == 0


def test_shards_do_not_depend_on_the_files(corpus, many_partitions):
    a = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(corpus).collect()}
    b = {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(corpus.repartition(13, "text")).collect()}
    assert a == b
    assert {r.doc_id: (r.shard, r.slot) for r in sharding.shard_rows(corpus, seed=9).collect()} != a


def test_every_row_of_one_document(spark):
    """One id and text in all rows: the rows still spread evenly."""
    rows = [(7, "same")] * 500
    check_shards(rows, sharding.shard_rows(make(spark, rows)).collect())
