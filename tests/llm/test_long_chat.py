"""Templates that change history only in long conversations."""

import pytest

from idloom.llm import chat


def shown(messages):
    return "".join(f"[{r}]{t}\n" for r, t in messages)


def trimmed(messages):
    return shown(messages)[-1500:]


def faded(messages):
    return shown([(r, t if i > len(messages) - 100 else "") for i, (r, t) in enumerate(messages)])


@pytest.mark.parametrize("template", [lambda m: shown(m[-100:]), trimmed, faded])
def test_long_history_is_seen(spark, template):
    rows = [(1, i, "user", f"said {i}") for i in range(200)] + [(2, i, "user", f"said {i}") for i in range(20)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: r for r in chat.digest(chat.format_turns(table, template)).collect()}
    assert got[1].rewrites_history and not got[2].rewrites_history and not got[2].context_dependent


def test_verified_turns(spark):
    table = spark.createDataFrame([(1, i, "user", f"said {i}") for i in range(200)], "conv_id long, turn long, role string, text string")
    rows = sorted(chat.format_turns(table).collect(), key=lambda r: r.position)
    assert [rows[i].verified for i in (0, 63, 100, 127, 150, 199)] == [1, 64, 64, 128, 128, 200]
    assert not any(r.rewrites_history or r.context_dependent for r in rows)


def passing(messages):
    """Blanks the first text in some prefixes that no doubling, window or end of the conversation shows."""
    return shown([(r, "" if i == 0 and 70 <= len(messages) <= 90 else t) for i, (r, t) in enumerate(messages)])


def numbered(messages):
    return "".join(f"[{r}{i}]{t}\n" for i, (r, t) in enumerate(messages))


def test_every_prefix_is_looked_at():
    locator, seen = chat.Locator(passing), []
    for i in range(200):
        locator.add("user", f"said {i}")
        seen.append(locator.rewrites)
    assert seen.index(True) == 69 and all(seen[69:])


def test_every_span_is_that_of_the_whole_conversation():
    messages = [("user", f"said {i}") for i in range(300)]
    locator, out = chat.Locator(numbered), ""
    for i, (role, text) in enumerate(messages):
        span, start, begin, end = locator.add(role, text)
        out += span
        assert (span, start, out[begin:end]) == (f"[user{i}]said {i}\n", len(out) - len(span), text)
    assert out == numbered(messages) and locator.dependent and not locator.rewrites
