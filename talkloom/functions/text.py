"""Text expressions: word counts, normal forms, prompts, and predicates on lines. All run in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: White space as Python's str.split() knows it, as part of a character class for Java and RE2.
SPACE = r"\s\x0b\x1c-\x1f\x85\p{Z}"
#: Cap on the words of a line.
MAX_WORDS = 30

# What the crew says and a passenger doesn't.
CREW_CUES = (
    r"(?i)\b(can i get you|would you like me to|is there anything (?:else )?(?:i|we) can|"
    r"i (?:can|could|will|'ll|’ll) (?:also )?(?:offer|bring) you|i'?ll (?:also )?(?:get|bring) you|"
    r"i can (?:also )?(?:speak|talk) (?:with|to) (?:our|my)|our purser|my colleague|"
    r"are you okay|you seem (?:a bit|rather|quite)|"
    r"we can'?t (?:accommodate|move|upgrade|change)|we'?ve checked|"
    r"i understand (?:your|that|you'?re|it'?s)\b[^.?!]{0,40}\bbut\b|"
    r"let me see (?:if|what) (?:i|we) can|i'?ll (?:also )?get the captain)\b"
)

# What follows the last message, and how a hint is worded up to a ratio.
TAIL = "\n\n(Reply with only what the passenger says next. The crew member's last sentence may be unfinished: do not complete it, and never write the crew's words.)"
HINT_LEVELS = [
    (0.65, "Rely mainly on the conversation so far; borrow at most a few keywords from the hint."),
    (0.8, "Follow the conversation and use the hint, but include some content that differs from it."),
    (None, "Say what the hint says, in slightly different words."),
]
#: Upper bounds of the ratio for the wordings of the full prompt; above the last one, the turn has been heard.
PROMPT_LEVELS = [0.5, 0.65, 0.8, 0.95, 0.99]


def tokens(text: Column) -> Column:
    """Parts between white space; none for null or blank text."""
    t = F.regexp_replace(F.coalesce(text, F.lit("")), rf"^[{SPACE}]+|[{SPACE}]+$", "")
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, rf"[{SPACE}]+"))


def n_words(text: Column) -> Column:
    """Parts between white space that have a letter."""
    return F.coalesce(F.regexp_count(text, F.lit(rf"[^{SPACE}]*\p{{L}}[^{SPACE}]*")), F.lit(0))


def plain_words(text: Column) -> Column:
    """Runs of a-z and apostrophes of the lower-case text."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[a-z']+"), F.lit(0))


def crew_form(text: Column) -> Column:
    """Lower case without punctuation, apostrophes kept, single blanks: as a recogniser writes."""
    t = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}_'{SPACE}]", " ")
    return F.regexp_replace(F.regexp_replace(t, rf"[{SPACE}]+", " "), "^ | $", "")


def letters_only(text: Column) -> Column:
    """Lower case, letters, digits and apostrophes only."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}']", "")


def aligner_form(text: Column, charset: str = "a-z'") -> Column:
    """Lower case with plain apostrophes, only what the aligner knows."""
    return F.regexp_replace(F.translate(F.lower(text), "’", "'"), f"[^{charset}]", "")


def reason_form(text: Column) -> Column:
    """A reason with lists as [..] and digits as #, at most 90 characters: reasons alike fall together."""
    return F.substring(F.regexp_replace(F.regexp_replace(text, r"\[[^\]]*\]", "[..]"), r"[0-9]+(\.[0-9]+)?", "#"), 1, 90)


def relabelled(context: Column) -> Column:
    """Context lines with passenger and crew for A and B; what the crew says in its recogniser form. Lines without colon stay."""

    def line(x: Column) -> Column:
        head, said = F.trim(F.substring_index(x, ":", 1)), F.regexp_replace(x, r"(?s)^[^:]*:", "")
        label = F.when(head == "A", "passenger").when(head == "B", "crew").otherwise(head)
        return F.when(~F.contains(x, F.lit(":")), x).when(label == "crew", F.concat(F.lit("crew: "), crew_form(said))).otherwise(F.concat(label, F.lit(":"), said))

    return F.array_join(F.transform(F.split(context, "\n"), line), "\n")


def user_message(conversation: Column, hint: Column) -> Column:
    """Non-blank lines without trailing white space, the hint block, and the fixed tail."""
    ls = F.transform(F.split(conversation, "\n"), lambda x: F.regexp_replace(x, rf"[{SPACE}]+$", ""))
    return F.concat(F.array_join(F.filter(ls, lambda x: x != ""), "\n"), hint, F.lit(TAIL))


def hint_block(ratio: Column, hint: Column) -> Column:
    """The hint in words that follow the ratio; empty in the first half of the turn."""
    how = F.lit(HINT_LEVELS[-1][1])
    for bound, text in reversed(HINT_LEVELS[:-1]):
        how = F.when(ratio <= bound, text).otherwise(how)
    block = F.concat(F.lit("\n\n(Hidden hint, never mention it: the passenger's next words will be similar to: \""), hint, F.lit('". '), how, F.lit(")"))
    return F.when(ratio <= 0.5, "").otherwise(block)


def prompt_level(ratio: Column) -> Column:
    """0 without hint, else 1 to 5 by the progress of the turn."""
    level = F.lit(len(PROMPT_LEVELS))
    for i, b in reversed(list(enumerate(PROMPT_LEVELS))):
        level = F.when(ratio <= b, i).otherwise(level)
    return level


def fallback_line(ratio: Column, hint: Column) -> Column:
    """Without a model: nothing in the first half of a turn, then the hint."""
    return F.when(ratio <= 0.5, "").otherwise(hint)


def shouts(text: Column) -> Column:
    """At least eight letters, more than four fifths of them upper case."""
    n = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce((n >= 8) & (F.regexp_count(text, F.lit(r"\p{Lu}")) / n > 0.8), F.lit(False))


def sounds_like_crew(text: Column) -> Column:
    return F.coalesce(text.rlike(CREW_CUES), F.lit(False))


def tagged(text: Column) -> Column:
    """Wrapped in <system> tags, once."""
    t = F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")
    return F.when(t.startswith("<system>") & t.endswith("<system>"), t).otherwise(F.concat(F.lit("<system> "), t, F.lit(" <system>")))


def filled(template: str, values: dict[str, Column]) -> Column:
    """The template with {{name}} replaced; an unknown name is an error when the plan is made."""
    import re

    unknown = set(re.findall(r"\{\{(\w+)\}\}", template)) - set(values)
    if unknown:
        raise ValueError(f"unknown placeholders: {sorted(unknown)}")
    out = F.lit(template)
    for k, v in values.items():
        out = F.replace(out, F.lit("{{" + k + "}}"), F.coalesce(v.cast("string"), F.lit("")))
    return out


def embedded_json(reply: Column) -> Column:
    """The outermost {...} of a reply, without what it thinks aloud; null if there is none."""
    t = F.regexp_replace(reply, r"(?s)<think>.*?</think>", "")
    return F.nullif(F.regexp_extract(t, r"(?s)\{.*\}", 0), F.lit(""))


def most_tokens(words: Column) -> Column:
    """Audio tokens that a line of so many words may take."""
    return (F.lit(12.5) * (words + 3)).cast("int")


# Words of a description by which the origin of a voice is told, in this order.
ORIGINS = [("british", "gb"), ("american", "us"), ("australian", "au"), ("canadian", "ca")]

# Number words.
ONES = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen".split()
TENS = "twenty thirty forty fifty sixty seventy eighty ninety".split()


def small_number(n: Column) -> Column:
    """0 to 99 in words, else null."""
    ones, tens = F.array(*[F.lit(x) for x in ONES]), F.array(*[F.lit(x) for x in TENS])
    unit = F.when(n % 10 > 0, F.concat(F.lit("-"), F.get(ones, n % 10))).otherwise("")
    return F.when(n < 20, F.get(ones, n)).when(n < 100, F.concat(F.get(tens, (n / 10).cast("int") - 2), unit))


def number_words(n: Column) -> Column:
    """0 to 999,999 in words, else null."""
    ones = F.array(*[F.lit(x) for x in ONES])

    def below(k: Column) -> Column:
        """A number below a thousand; empty for 0."""
        high, low = F.floor(k / 100).cast("int"), (k % 100).cast("int")
        return F.concat_ws(" ", F.when(high > 0, F.concat(F.get(ones, high), F.lit(" hundred"))), F.when(low > 0, small_number(low)))

    k = n.cast("int")
    thousands, rest = F.floor(k / 1000).cast("int"), (k % 1000).cast("int")
    said = F.concat_ws(" ", F.when(thousands > 0, F.concat(below(thousands), F.lit(" thousand"))), F.nullif(below(rest), F.lit("")))
    return F.when((n >= 0) & (n < 1_000_000), F.when(k == 0, "zero").otherwise(said))


def voice_fields(description: Column, tier: Column) -> Column:
    """struct<gender, origin, tier> of a voice from its description; the tier is 'pool' where none is given."""
    d = F.lower(F.coalesce(description, F.lit("")))
    origin = F.lit("intl")
    for word, code in reversed(ORIGINS):
        origin = F.when(F.contains(d, F.lit(word)), code).otherwise(origin)
    return F.struct(F.when(d.rlike("^(?:female|woman)"), "female").otherwise("male").alias("gender"), origin.alias("origin"), F.coalesce(tier, F.lit("pool")).alias("tier"))


def digit_words(text: Column) -> Column:
    """The digits of a text, each in words."""
    ones = F.array(*[F.lit(x) for x in ONES])
    ds = F.regexp_extract_all(text, F.lit("[0-9]"), F.lit(0))
    return F.array_join(F.transform(ds, lambda d: F.get(ones, d.cast("int"))), " ")
