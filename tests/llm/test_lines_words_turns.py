"""Line dedup, spelling variants and conversation repair against brute force,
SQL and awkward inputs."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from tidecast.llm import conversation_repair as cr
from tidecast.llm import line_dedup, queries, spelling
from tidecast.plans.verify import compare, duckdb_conn

SMALL = "/root/testdata/sf0.01"
BLANKS = " \t\n\x0b\x0c\r"
DOCS = "doc_id bigint, text string, n string, pos string, rank string, print string, word string, key string"
TURNS = "conv_id bigint, turn bigint, role string, text string, kind string, copies string, part string"


def lower_az(s):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def doc_frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c", "d", "e", "f") for r in rows], DOCS)


def turn_frame(spark, rows):
    return spark.createDataFrame([(*r, "a", "b", "c") for r in rows], TURNS)


# -- lines -------------------------------------------------------------------

LINES = ["Home | About", "home | about ", "\tHOME | ABOUT\r", "Éa", "éa", "", " ", "K", "K", "one", "two"]


def line_rows():
    rng = random.Random(3)
    rows = [(i, "\n".join(rng.choice(LINES + [f"own {i}", f"own {i}"]) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    rows += [(7, rows[7][1])] * 3 + [(8, "Home | About\nagain"), (None, None), (None, "two"), (None, "two"), (99, ""), (100, "\n\n")]
    return rows + [(101, "\n".join(f"long {i % 5000}" for i in range(20_000)) + "\ntwo")]


def brute_lines(rows, least):
    keys = [[lower_az(x.strip(BLANKS)) for x in (t or "").split("\n")] for _, t in rows]
    seen = Counter(k for ks in keys for k in set(ks) if k)
    out = []
    for (i, text), ks in zip(rows, keys):
        gone = [bool(k) and seen[k] >= least for k in ks]
        kept = "\n".join(x for x, g in zip((text or "").split("\n"), gone) if not g)
        out.append((str(i), len(ks), sum(gone), kept))
    return sorted(out)


@pytest.mark.parametrize("least", [2, 10])
def test_lines_equal_brute_force(spark, least):
    rows = line_rows()
    got = line_dedup.without_common_lines(doc_frame(spark, rows), min_docs=least).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == brute_lines(rows, least)


def test_lines_over_many_partitions_with_a_hot_line(spark):
    rows = [(i, f"hot\nmine {i}\nhot") for i in range(400)] + [(1000 + i, f"pair {i // 2}") for i in range(40)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = line_dedup.without_common_lines(doc_frame(spark, rows), min_docs=2).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == brute_lines(rows, 2)


def test_first_occurrence_stays(spark):
    rows = [(3, "x\ny\nx"), (1, "y\nz"), (2, "z\nX\nz\nw")]
    got = line_dedup.without_common_lines(doc_frame(spark, rows), min_docs=1, keep_first=True).collect()
    assert {r.doc_id: r.kept for r in got} == {1: "y\nz", 2: "X\nw", 3: ""}


def test_bitmaps_are_run_lengths(spark):
    rows = [(i, "a\nb\n" + f"m {i}\n" + "c\n" + f"n {i}") for i in range(4)]
    got = line_dedup.keep_bitmaps(doc_frame(spark, rows), min_docs=4).collect()
    assert {r.doc_id: (r.n_dropped, r.runs) for r in got} == {i: (3, [0, 2, 1, 1]) for i in range(4)}


def test_lines_of_no_rows(spark):
    assert line_dedup.without_common_lines(spark.createDataFrame([], DOCS)).collect() == []


def test_lines_query_equals_sql(spark):
    got = compare(queries.op11_line_dedup(spark, SMALL), queries.SQL["op11_line_dedup"], duckdb_conn(SMALL))
    assert got["match"], got


def test_lines_run_no_python(spark):
    plan = queries.op11_line_dedup(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# -- spelling ----------------------------------------------------------------

def brute_spelling(rows, factor=10):
    count = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lower_az(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    shapes = defaultdict(set)
    for w in words:  # two words are near only if they share a word with one character less, or one is it
        for j in range(len(w)):
            shapes[w[:j] + w[j + 1:]].add(w)
        shapes[w].add(w)

    def is_near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(b[:j] + b[j + 1:] == a for j in range(len(b)))

    near = defaultdict(set)
    for group in shapes.values():
        for a, b in itertools.permutations(group, 2):
            if is_near(a, b):
                near[a].add(b)
    form = {}
    for w, n in words.items():
        top = min(near[w], key=lambda x: (-words[x], x), default=None)
        if top is not None and words[top] >= factor * n:
            form[w] = top

    def root(w):
        return root(form[w]) if w in form else w
    return sorted((w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items())


def spelled(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect())


def test_spelling_query_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = spelled(queries.op12_spelling(spark, SMALL))
    assert got == brute_spelling(rows)
    assert sum(1 for r in got if r[1]) > 10


def test_spelling_of_odd_words(spark):
    words = {"committee": 2500, "comittee": 210, "comitte": 20, "comitt": 9, "comite": 30, "committé": 3, "Committee": 4, "aaaaaaa": 40, "aaaaaaaa": 3,
             "aaaaaab": 2, "baaaaaa": 2, "abaaaaa": 40, "×zzzzzz": 2, "÷zzzzzz": 25, "zzzzzzÉ": 2, "zzzzzzé": 2, "short": 50,
             "lonelyÿword": 2, "singleword": 1, "commytee": 2}
    # ids that leave the words whole, but for some
    rows = [(i, w) for w, n in words.items() for i in itertools.islice((i for i in itertools.count() if zlib.crc32(f"{i}:{lower_az(w)}".encode()) % 31), n)]
    rows += [(i, "committee") for i in range(9000, 9400)] + [(50, None), (None, "committee7committee x"), (51, ""), (52, "a" * 3000 + " " + "a" * 3000), (53, "a" * 3001 + " " + "a" * 3001)]
    rows += [(50, "committee")] * 2
    got = spelled(spelling.spelling_forms(doc_frame(spark, rows)))
    assert got == brute_spelling(rows)
    assert {r[0]: r[2] for r in got if r[1]}["comitte"] == "committee"


def test_spelling_of_no_rows(spark):
    assert spelling.spelling_forms(spark.createDataFrame([], DOCS)).collect() == []


def test_rotations_meet_only_where_they_should():
    words = ["abcdefg", "abcdefh", "abcdef", "abcabca"]
    owner, k1, k2, last = spelling.rotation_prints(words)
    shown = []
    for w in words:
        shown += [(w[j + 1:] + "$" + w[:j], ord(w[j])) for j in range(len(w))]
    for w in words:
        shown += [(w[j:] + "$" + w[:j], 0) for j in range(len(w) + 1)]
    by_print, by_text = defaultdict(set), defaultdict(set)
    for i, (text, char) in enumerate(shown):
        assert last[i] & 0xFFFFFF == char
        by_print[k1[i], k2[i]].add(i)
        by_text[text].add(i)
    # rotation_prints lists all cut rotations first, then all whole ones
    assert sorted(map(sorted, by_print.values())) == sorted(map(sorted, by_text.values()))


# -- conversations -----------------------------------------------------------

def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        h = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if h == 0:
            continue
        text = "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
        out += [(conv, turn, "user" if h == 4 else role, text)] * (2 if h == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        solid = re.findall("[^\x20\x09-\x0D]", text)
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "sound")
        seen.add((role, text))
    return out


def next_state(state, initial):
    """Read off the pattern itself: a prefix is kept if it can still become legal."""
    grown = state + initial
    return grown if re.fullmatch("s?(ua)*u?", grown) else None


def fold(state):
    """States that behave alike: none, s, ends in u, ends in a."""
    return state if state in ("", "s") else state[-1]


def cheapest(rows, kinds):
    """(cost, audit, repaired lines) of every way, one row at a time, insertions by relaxation."""
    def better(table, key, entry):
        if key not in table or entry[:2] < table[key][:2]:
            table[key] = entry
            return True
        return False

    def grow(state, initial):
        full = {"": "", "s": "s", "u": "u", "a": "ua"}[state]
        new = next_state(full, initial)
        return None if new is None else fold(new)

    def relax(table):
        again = True
        while again:
            again = False
            for state, (cost, audit, lines) in list(table.items()):
                for name in ("user", "assistant"):
                    if (to := grow(state, name[0])) is not None:
                        again |= better(table, to, (cost + 5, audit + "I", (*lines, f"{name}:")))
    table = {"": (0, "", ())}
    relax(table)
    for (_, _, role, text), kind in zip(rows, kinds):
        new = {}
        for state, (cost, audit, lines) in table.items():
            better(new, state, (cost + 2, audit + "D", lines))
            if kind in ("blank", "duplicate"):
                continue
            extra = 5 if kind == "truncated" else 0
            if role[:1] and (to := grow(state, role[:1])) is not None:
                better(new, to, (cost + extra, audit + "K", (*lines, f"{role}:{text}")))
            for name in ("user", "assistant"):
                if (to := grow(state, name[0])) is not None:
                    better(new, to, (cost + extra + 1, audit + "R", (*lines, f"{name}:{text}")))
        relax(new)
        table = new
    return min(table[s] for s in ("", "a") if s in table)


def brute_repair(rows):
    by_conv, out = defaultdict(list), []
    for r in rows:
        by_conv[r[0]]
    for r in damage(rows):
        by_conv[r[0]].append(r)
    for conv, turns in by_conv.items():
        turns.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        known = [r[1] for r in turns if r[1] is not None]
        kinds = faults(turns)
        cost, audit, lines = cheapest(turns, kinds)
        out.append((str(conv), max(known) - min(known) + 1 - len(set(known)) if known else 0, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")],
                    sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:])),
                    cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out)


def repaired(df):
    return sorted((str(r.conv_id), r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256)
                  for r in cr.repair(cr.damaged(df)).collect())


@pytest.mark.parametrize("name", ["sf0.001", "sf0.01", "sf0.1"])
def test_repair_equals_brute_force_on_tables(spark, name):
    df = spark.read.parquet(f"/root/testdata/{name}/conversations.parquet")
    rows = [(r.conv_id, r.turn, r.role, r.text) for r in df.collect()]
    assert repaired(df) == brute_repair(rows)


def odd_turns():
    rng = random.Random(11)
    roles, texts = ["system", "user", "assistant", "tool", "", None, "User", "up"], ["Hi.", "Yes!", "no", "", " \n", None, "A?", "end. ", "x "]
    rows = []
    for conv in [None, *range(-2, 120)]:
        for _ in range(rng.randrange(0, 12)):
            rows.append((conv, rng.choice([None, *range(14)]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts) if rng.random() < .6 else f"T{rng.random()}."))
    rows += [(500, t, ("user", "assistant")[t % 2] if t % 7 else "user", f"line {t % 40}.") for t in range(900)]
    return rows + [(501, 5, "user", "same.")] * 50 + [(502, None, None, None)] * 3


def test_repair_equals_brute_force_on_odd_rows(spark):
    rows = odd_turns()
    assert repaired(turn_frame(spark, rows)) == brute_repair(rows)


def test_repair_of_a_conversation_in_many_partitions(spark):
    rows = odd_turns()
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert repaired(turn_frame(spark, rows)) == brute_repair(rows)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_repair_of_no_rows(spark):
    assert repaired(spark.createDataFrame([], TURNS)) == []


def test_cells_equal_enumeration():
    """Every edit of up to three rows with up to two insertions at each place."""
    costs = {"D": 2, "I": 5}
    ways = ["", "u", "a", "ua", "au"]
    for n in range(4):
        for rows in itertools.product([(i, f) for i in "suat" for f in ("sound", "truncated", "blank")], repeat=n):
            if n == 3 and zlib.crc32(repr(rows).encode()) % 12:
                continue
            found = []
            options = [[("D", "", 2)] + ([] if f == "blank" else [("K", i, 5 * (f == "truncated"))] + [("R", r, 1 + 5 * (f == "truncated")) for r in "ua"])
                       for i, f in rows]
            for edits in itertools.product(*options):
                for ins in itertools.product(ways, repeat=n + 1):
                    text = ins[0] + "".join(e[1] + x for e, x in zip(edits, ins[1:]))
                    if re.fullmatch("(s?(ua)+)?", text):
                        audit = "I" * len(ins[0]) + "".join(e[0] + "I" * len(x) for e, x in zip(edits, ins[1:]))
                        found.append((sum(e[2] for e in edits) + costs["I"] * sum(map(len, ins)), audit))
            assert cr.best(cr.parse([(i, f, 1) for i, f in rows])) == min(found), rows


def test_split_of_a_span_does_not_matter():
    rng = random.Random(1)
    rows = [(rng.choice("suat"), rng.choice(["sound", "truncated", "blank", "duplicate"]), rng.choice([1, 1, 3])) for _ in range(60)]
    want = cr.parse(rows)
    for cut in (1, 7, 30, 59):
        assert cr.combine(cr.parse(rows[:cut]), cr.parse(rows[cut:])) == want
