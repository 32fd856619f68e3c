import hashlib
import random
import zlib
from collections import Counter, defaultdict

from tempestry.llm import conversations
from tempestry.llm.common import ship
from tempestry.llm.queries import QUERIES, SQL
from tests.llm.cases import SF, prose
from tests.oracle import compare, connect

SCHEMA = "conv_id long, turn long, role string, text string, depth long, head string, length int, h1 long"


def table(spark, rows):
    return spark.createDataFrame([(*r, 7, "h", 7, 7) for r in rows], SCHEMA)


def slow_trie(rows, family=20, most=3):
    turns = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            turns[conv].append((turn is not None, turn or 0, digest, role, text))
    turns = {c: [t[3:] for t in sorted(v)] for c, v in turns.items()}
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % (most + 1)
        base = c - (abs(c) % family) * (1 if c >= 0 else -1)
        rebuilt[c] = turns.get(base, [])[:h] + own[h:]
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(rebuilt):
        for d in range(len(rebuilt[c]) + 1):
            members[tuple(rebuilt[c][:d])].append(c)
        ends[tuple(rebuilt[c])].append(str(c))
    children = Counter(k[:-1] for k in members if k)
    leaves, saved = Counter(), Counter()
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += children[k] == 0
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1].encode().split()) if k else 0
    return Counter(
        (m[0], len(k), members[k[:-1]][0] if k else None, len(m), children[k], leaves[k], saved[k],
         hashlib.sha256(",".join(ends[k]).encode()).hexdigest())
        for k, m in members.items()
    )


def as_set(df):
    return Counter(map(tuple, df.collect()))


def test_sql(spark):
    assert compare(QUERIES["op11_prefix_trie"](spark, SF), connect(SF), SQL["op11_prefix_trie"]) > 0


def awkward_rows():
    long = prose(4, 9000)
    rows = [(None, 1, "user", "lost"), (3, None, None, None), (3, 2, "user", ""), (3, 1, "user", "a b"), (5, 0, "u", "x"), (5, 0, "u", "x"),
            (5, 0, "ux", ""), (-3, 1, "user", long), (-25, 0, "user", "minus"), (-20, 0, "user", "base"), (41, 0, "", "ab"), (42, 0, "a", "b"),
            (43, 0, "user", "x\ny \t z"), (44, None, "user", "x"), (44, None, "user", "x")]
    r = random.Random(8)
    for c in [*range(60, 130), 10**15, 2**62]:
        for t in range(r.choice((1, 2, 3, 4, 9))):
            rows.append((c, t, r.choice(("user", "assistant")), r.choice(("yes", "no", "why is that", "two words"))))
    return rows


def test_awkward_rows(spark):
    ship(spark)
    rows = awkward_rows()
    found = conversations.prefix_trie(table(spark, rows))
    assert ", ".join(f"{c} {k}".replace("bigint", "long") for c, k in found.dtypes) == conversations._OUT_SQL
    assert as_set(found) == slow_trie(rows)


def test_long_conversations_over_ranges_and_rounds(spark):
    ship(spark)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = random.Random(2)
        rows = [(101, t, "user", r.choice("ab")) for t in range(90)]
        rows += [(c, t, "user", rows[t][3] if t < 70 - c else "c d") for c in range(61, 70) for t in range(20)]
        rows += [(c, 0, "user", "the same hello") for c in range(200, 240)] + [(c, 1, "user", f"w {c % 7}") for c in range(200, 230)]
        rows += [(c, t, "user", "hot copy") for c in range(300, 360) for t in range(3)]
        r.shuffle(rows)
        found = conversations.prefix_trie(table(spark, rows).repartition(4), family=1000, largest=20)
        assert as_set(found) == slow_trie(rows, 1000)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_no_conversations(spark):
    ship(spark)
    for rows in ([], [(None, 1, "user", "x")]):
        found = conversations.prefix_trie(table(spark, rows))
        assert found.count() == 0 and found.columns[0] == "conv_id"
    one = conversations.prefix_trie(table(spark, [(1, 0, "u", "x")])).collect()  # h is 3, no base: the root alone
    assert [tuple(x)[:7] for x in one] == [(1, 0, None, 1, 0, 1, 0)]


def test_centroid_sums_of_random_trees():
    r = random.Random(5)
    for _ in range(300):
        n = r.randint(1, 60)
        chain = r.random()
        parents = [-1] + [v - 1 if r.random() < chain else r.randrange(v) for v in range(1, n)]
        depth = [0] * n
        for v in range(1, n):
            depth[v] = depth[parents[v]] + 1
        order = sorted(range(n), key=depth.__getitem__)
        place = {v: i for i, v in enumerate(order)}
        parents = [place[parents[v]] if v else -1 for v in order]
        weights = [r.randint(1, 5) for _ in order]
        values = [(r.randint(0, 3), r.randint(0, 100)) for _ in order]
        want = [list(v) for v in values]
        whole = list(weights)
        for v in reversed(range(1, n)):
            for i in (0, 1):
                want[parents[v]][i] += want[v][i]
            whole[parents[v]] += whole[v]
        assert conversations.centroid_sums(parents, whole, values) == want
