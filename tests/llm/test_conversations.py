import hashlib
import itertools
import random
import re
import zlib

import pytest

from tripmart.llm import conversations as C

SCHEMA = "conv_id bigint, turn bigint, role string, text string, fault string, audit string, at int, `copy` string"
BLANK = " \t\n\x0b\x0c\r"


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "f", "a", 1, "c") for r in rows], SCHEMA)


def hurt(rows):
    """Conversations after the damage, row by row."""
    out = {}
    for conv, turn, role, text in rows:
        conv_rows = out.setdefault(conv, [])
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        for copy in range(1 + (kind == 3)):
            conv_rows.append((turn, "user" if kind == 4 else role, text, copy))
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), hashlib.sha256(x[2].encode()).hexdigest(), x[3]))
            for c, r in out.items()}


def report(rows):
    """Expected row of a conversation, but cost, audit and hash, and its letters."""
    seen, letters, counts, pairs = set(), "", {"blank": 0, "duplicate": 0, "truncated": 0}, 0
    for k, (_, role, text, _) in enumerate(rows):
        bare = text.rstrip(BLANK)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
        letters += "x" if fault in ("blank", "duplicate") else letter.upper() if fault else letter
        pairs += k > 0 and rows[k - 1][1][:1] + role[:1] not in ("su", "ua", "au")
    turns = [t for t, *_ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return letters, (gaps, counts["blank"], counts["duplicate"], counts["truncated"], pairs)


def plain(letters, costs=C.Costs(), most_inserted=3):
    """Cheapest audit by trying all edits, with up to ``most_inserted`` insertions between rows."""
    best = None
    for plan in itertools.product("KRD", repeat=len(letters)):
        cost, options = 0, []
        for letter, edit in zip(letters, plan):
            if edit == "D":
                cost += costs.delete
                options.append([""])
                continue
            cost += (costs.keep if edit == "K" else costs.rerole) + (costs.truncated if letter.isupper() else 0)
            if letter == "x" or edit == "K" and letter.lower() == "o":
                break
            options.append([letter.lower()] if edit == "K" else ["u", "a"])
        if len(options) < len(letters):
            continue
        for slots in itertools.product(range(most_inserted + 1), repeat=len(letters) + 1):
            total = cost + costs.insert * sum(slots)
            if sum(slots) > most_inserted or best and total > best[0]:
                continue
            audit = "I" * slots[0] + "".join(e + "I" * n for e, n in zip(plan, slots[1:]))
            fills = [[""] if not n else ["".join(x) for x in itertools.product("ua", repeat=n)] for n in slots]
            parts = [fills[0]] + [x for o, f in zip(options, fills[1:]) for x in (o, f)]
            if any(re.fullmatch("(s?(ua)+)?", "".join(p)) for p in itertools.product(*parts)):
                best = min(best, (total, audit)) if best else (total, audit)
    return best


@pytest.mark.parametrize("costs", [C.Costs(), C.Costs(0, 3, 4, 1, 1), C.Costs(0, 1, 1, 1, 0), C.Costs(0, 2, 9, 2, 5)])
def test_automaton_equals_trying_all_edits(costs):
    rng = random.Random(2)
    words = {"".join(rng.choice("suaoSUAOx") for _ in range(rng.randint(0, 4))) for _ in range(90)} | {"", "s", "ua", "sua", "uu"}
    automaton = C.SuffixAutomaton(costs)
    for ending in sorted(w[::-1] for w in words):
        automaton.push(ending.encode())
        assert automaton.best() == plain(ending[::-1], costs), ending[::-1]


def test_shared_suffixes_are_made_once():
    automaton = C.SuffixAutomaton()
    words = ["ua" * 50, "sua" + "ua" * 49, "u" + "ua" * 50, "ua" * 50]
    for w in sorted(x[::-1] for x in words):
        automaton.push(w.encode())
    assert automaton.made == 1 + 100 + 2  # the end, the longest common suffix, and two longer ones


def edge_rows():
    rng = random.Random(9)
    rows = [(None, 1, "user", "Hello."), (None, None, None, None), (None, 2, "assistant", "Fine!"),
            (1, None, "user", "A?"), (1, None, "user", "A?"), (1, None, "assistant", None), (2, 3, "", "x."), (2, 4, "tool", "y."),
            (3, 1, "user", "same."), (3, 1, "user", "same."), (3, 1, "assistant", "other."), (3, -5, "system", "é ß \U0001f600."),
            (4, 9, "User", "z."), (5, 1 << 40, "user", " \t. \n\r "), (6, 1, "user", "word " * 200_000 + "."), (6, 2, "assistant", "ok" + " " * 100_000)]
    rows += [(7, t, ("user", "assistant")[t % 2], "Yes." if t % 3 == 0 else f"Line {t}.") for t in range(700)]  # a third of all rows
    for conv in range(100, 260):
        for t in range(rng.randint(1, 7)):
            rows.append((conv, t if rng.random() < 0.9 else t + 4, rng.choice(["user", "assistant", "assistant", "system", "user"]),
                         rng.choice(["Yes.", "No!", "cut", "", " ", "What? ", f"Text {t}."])))
    return rows


def test_equals_row_by_row_repair(spark):
    rows = edge_rows()
    source = C.damaged(conversations(spark, rows))
    audited = C.audits(C.faults(source)).persist()
    expected = {c: report(r) for c, r in hurt(rows).items()}
    found = {r.conv_id: r for r in audited.collect()}
    assert found.keys() == expected.keys() and len(found) == audited.count()
    for c, (letters, counts) in expected.items():
        r = found[c]
        assert r.signature == letters and (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal) == counts
        if len(letters) <= 6:
            assert (r.cost, r.audit) == plain(letters, most_inserted=2)
    sums = {r.conv_id: r.repaired_sha256 for r in C.digests(C.repaired(source, audited)).collect()}
    assert sums.keys() == expected.keys()
    for c, r in hurt(rows).items():
        out, initials, at = [], "", 0
        for edit in found[c].audit:
            turn_of = "user" if not re.fullmatch("s?(ua)*u", initials) else "assistant"
            if edit == "I":
                out.append((turn_of, ""))
            else:
                _, role, text, _ = r[at]
                at += 1
                if edit == "D":
                    continue
                out.append((role if edit == "K" else turn_of, text))
            initials += out[-1][0][0]
        assert at == len(r) and re.fullmatch("(s?(ua)+)?", initials)
        assert sums[c] == hashlib.sha256("\n".join(f"{x}:{t}" for x, t in out).encode()).hexdigest()
    kept = C.repaired(source, audited).where("at >= 0")
    assert kept.columns == ["conv_id", "at", "turn", "role", "text", "edit"]
    assert kept.where("conv_id = 7 AND edit = 'K'").count() == found[7].audit.count("K")


def test_empty_table(spark):
    source = C.damaged(conversations(spark, []))
    audited = C.audits(C.faults(source))
    assert audited.count() == 0 and C.digests(C.repaired(source, audited)).count() == 0


def test_dropped_conversations_stay_in_the_report(spark):
    gone = [i for i in range(400) if zlib.crc32(f"{i}:0".encode()) % 20 == 0][:3]
    audited = C.audits(C.faults(C.damaged(conversations(spark, [(i, 0, "user", "Hi.") for i in gone]))))
    rows = audited.collect()
    assert sorted(r.conv_id for r in rows) == gone
    assert all((r.gaps, r.blank, r.illegal, r.cost, r.audit) == (0, 0, 0, 0, "") for r in rows)


def test_insertions_are_made_where_they_are_cheap(spark):
    source = C.damaged(conversations(spark, [(1001, 50, "user", "One.")])).withColumns({})
    audited = C.audits(C.faults(source), C.Costs(insert=1))
    assert audited.first().audit == "KI"
    rows = [(r["at"], r.role, r.text, r.edit) for r in C.repaired(source, audited).where("at >= 0").collect()]
    assert rows == [(0, "user", "One.", "K"), (1, "assistant", "", "I")]
