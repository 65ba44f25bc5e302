"""Ragged lists and frame streams as array expressions; all run in the JVM.

Streams are array<array<int>> (codebooks by frames). Empty and null arrays have a defined result: packing no
lists gives no values and the offset 0, slices beyond the end are shorter, null arrays give null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Audio codes of silence and of the sine tone, by codebook.
SILENCE = [948, 243, 1178, 546, 1736, 1030, 1978, 2008]
SINE = [430, 1268, 381, 1611, 1095, 1495, 56, 472]
SILENCE_FRAMES = 6


def _i(x: Column | int) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def part(a: Column, start: Column | int, length: Column | int) -> Column:
    """``length`` elements from the 0-based ``start``; shorter at the end, empty for no or negative length."""
    s, n = _i(start), _i(length)
    return F.when(n <= 0, F.slice(a, 1, 0)).otherwise(F.slice(a, s.cast("int") + 1, F.greatest(n, F.lit(0)).cast("int")))


def repeat(x: Column | int, n: Column | int) -> Column:
    return F.array_repeat(_i(x), F.greatest(_i(n), F.lit(0)).cast("int"))


def pack(lists: Column) -> Column:
    """struct<values, offsets>: lists laid end to end, and where each begins; one offset more than lists."""
    offsets = F.aggregate(lists, F.array(F.lit(0)), lambda a, x: F.concat(a, F.array(F.element_at(a, -1) + F.size(x))))
    return F.struct(F.flatten(lists).alias("values"), offsets.alias("offsets"))


def packed_item(values: Column, offsets: Column, i: Column | int) -> Column:
    """The list ``i`` (0-based) of packed lists; null beyond the end."""
    a, b = F.get(offsets, _i(i)), F.get(offsets, _i(i) + 1)
    return F.when(b.isNotNull(), part(values, a, b - a))


def unpack(values: Column, offsets: Column) -> Column:
    n = F.size(offsets) - 1
    return F.when(n <= 0, F.array().cast("array<array<int>>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: packed_item(values, offsets, i)))


def packed_subset(values: Column, offsets: Column, keep: Column) -> Column:
    """The packed lists at the 0-based places ``keep``, packed again."""
    return pack(F.transform(keep, lambda i: packed_item(values, offsets, i)))


def shifted_events(events: Column, shift: Column | int, n_frames: Column | int, fields: Sequence[str]) -> Column:
    """Events (structs with ``pos``) moved by ``shift`` and kept inside [0, n_frames)."""
    move = lambda e: F.struct((e["pos"] + _i(shift)).cast("int").alias("pos"), *[e[f].alias(f) for f in fields if f != "pos"])
    return F.filter(F.transform(events, move), lambda e: (e["pos"] >= 0) & (e["pos"] < _i(n_frames)))


def merged(text: Column, audio: Column, pad: int) -> Column:
    """Text as the first stream above the audio, cut or padded to its length."""
    n = F.size(F.get(audio, F.lit(0)))
    return F.concat(F.array(part(F.concat(text, repeat(pad, n)), 0, n)), audio)


def main_streams(own: Column, other: Column) -> Column:
    """A speaker's streams followed by the other one's audio."""
    return F.concat(own, F.slice(other, 2, 8))


def _lit_array(xs: Sequence[int]) -> Column:
    return F.array(*[F.lit(x) for x in xs])


def delayed(streams: Column, delays: Sequence[int], initial: Sequence[int], pad: Sequence[int]) -> Column:
    """Each stream behind 1 + its delay initial tokens, padded to a common length of 1 + T + the longest delay."""
    most = max(delays, default=0)
    d, i0, p = _lit_array(delays), _lit_array(initial), _lit_array(pad)
    return F.transform(streams, lambda s, k: F.concat(repeat(F.get(i0, k), F.get(d, k) + 1), s, repeat(F.get(p, k), F.lit(most) - F.get(d, k))))


def undelayed(streams: Column, delays: Sequence[int]) -> Column:
    """Takes the delays (without the initial column) back; null if the streams are too short."""
    most = max(delays, default=0)
    n = F.size(F.get(streams, F.lit(0))) - most
    d = _lit_array(delays)
    return F.when(n > 0, F.transform(streams, lambda s, k: part(s, F.get(d, k), n)))


def chunk_bounds(n: Column, most: int) -> Column:
    """array<struct<start, size>> of ceil(n / most) chunks whose sizes differ by one at most, larger first; none for 0."""
    k = F.ceil(n / most).cast("int")
    q, r = F.floor(n / F.greatest(k, F.lit(1))).cast("int"), (n % F.greatest(k, F.lit(1))).cast("int")
    one = lambda c: F.struct((c * q + F.least(c, r)).cast("int").alias("start"), (q + F.when(c < r, 1).otherwise(0)).cast("int").alias("size"))
    return F.when(k < 1, F.array().cast("array<struct<start:int,size:int>>")).otherwise(F.transform(F.sequence(F.lit(0), F.greatest(k, F.lit(1)) - 1), one))


def stream_chunk(streams: Column, bound: Column) -> Column:
    return F.transform(streams, lambda s: part(s, bound["start"], bound["size"]))


def chunk_events(events: Column, bound: Column, fields: Sequence[str]) -> Column:
    """Events inside a chunk, at places counted from its start."""
    inside = F.filter(events, lambda e: (e["pos"] >= bound["start"]) & (e["pos"] < bound["start"] + bound["size"]))
    return F.transform(inside, lambda e: F.struct((e["pos"] - bound["start"]).cast("int").alias("pos"), *[e[f].alias(f) for f in fields if f != "pos"]))


def labels(streams: Column, initial: Sequence[int], zero: int) -> Column:
    """Tokens at or above a stream's initial id are no targets."""
    i0 = _lit_array(initial)
    return F.transform(streams, lambda s, k: F.transform(s, lambda v: F.when(v < F.get(i0, k), v).otherwise(zero)))


def whole_if_prompted(n_chunks: Column, prompt: Column | int) -> Column:
    """True; an error when run if a row with a prompt would be cut into several chunks."""
    bad = (_i(prompt) > 0) & (n_chunks > 1)
    return F.when(bad, F.raise_error(F.lit("a row with a prompt must not be split")).cast("boolean")).otherwise(F.lit(True))


def masked_prompt(labels_: Column, delays: Sequence[int], prompt: Column | int, zero: int) -> Column:
    """The first 1 + delay + prompt labels of each stream are no targets."""
    d = _lit_array(delays)
    return F.transform(labels_, lambda s, k: F.transform(s, lambda v, j: F.when(j < F.get(d, k) + 1 + _i(prompt), zero).otherwise(v)))


def prompt_prefix(voice: Column, text_ids: Column, pad: int) -> tuple[Column, Column]:
    """The prefix of a row: own streams (text and voice) and the other side's (padding and a sine tone).

    Voice codes without their first frame, silence, text ids over silence, silence.
    """
    n_voice, n_text = F.greatest(F.size(F.get(voice, F.lit(0))) - 1, F.lit(0)), F.size(text_ids)
    quiet = F.lit(SILENCE_FRAMES)
    total = n_voice + n_text + 2 * quiet
    text = F.concat(repeat(pad, n_voice + quiet), text_ids, repeat(pad, quiet))
    sil = _lit_array(SILENCE)
    audio = F.transform(voice, lambda s, k: F.concat(part(s, 1, n_voice), repeat(F.get(sil, k), n_text + 2 * quiet)))
    other = F.concat(F.array(repeat(pad, total)), F.transform(_lit_array(SINE), lambda c: repeat(c, total)))
    return F.concat(F.array(text), audio), other


def prompted(streams: Column, prefix: Column, most: int, least: int) -> Column:
    """A row behind its prefix, cut to ``most`` frames; null if fewer than ``least`` frames of the row are kept."""
    p = F.size(F.get(prefix, F.lit(0)))
    keep = F.least(F.lit(most) - p, F.size(F.get(streams, F.lit(0))))
    return F.when(keep >= least, F.zip_with(prefix, streams, lambda a, b: F.concat(a, part(b, 0, keep))))


def shifted(stream: Column, by: Column | int, pad: int) -> Column:
    """Right for positive, left for negative shifts; the length stays, the free places are padded."""
    s, n = _i(by), F.size(stream)
    k = F.least(F.abs(s), n)
    return F.when(s >= 0, F.concat(repeat(pad, k), part(stream, 0, n - k))).otherwise(F.concat(part(stream, k, n - k), repeat(pad, k)))


def frames_of_events(events: Column, n: Column | int, pad: int, start: int) -> Column:
    """One stream from events (pos, tokens): a start mark at the event's frame and its tokens behind, later events writing over earlier ones."""
    base = repeat(pad, n)

    def write(row: Column, e: Column) -> Column:
        t = F.concat(F.array(F.lit(start)), e["tokens"])
        room = part(t, 0, _i(n) - e["pos"])
        return F.concat(part(row, 0, e["pos"]), room, part(row, e["pos"] + F.size(room), _i(n) - e["pos"] - F.size(room)))

    inside = F.filter(events, lambda e: (e["pos"] >= 0) & (e["pos"] < _i(n)))
    return F.aggregate(inside, base, write)


def sorted_events(events: Column) -> Column:
    """Events in the order of ``pos``; those of one place stay in the order they are given in."""
    tagged = F.transform(events, lambda e, i: F.struct(e["pos"].alias("pos"), i.alias("i"), e.alias("e")))
    return F.transform(F.array_sort(tagged), lambda x: x["e"])


def prompted_events(events: Column, first: Column | int, kept: Column | int, prompt: Column | int, fields: Sequence[str]) -> Column:
    """Events of a row behind a prompt: those in [``first``, ``kept``) of the row, moved by the prompt's frames."""
    inside = F.filter(events, lambda e: (e["pos"] >= _i(first)) & (e["pos"] < _i(kept)))
    return F.transform(inside, lambda e: F.struct((e["pos"] + _i(prompt)).cast("int").alias("pos"), *[e[f].alias(f) for f in fields if f != "pos"]))


def chosen_events(events: Column, n: Column | int, hint_only: Column | bool = False, skip: Column | float = 0.0, jitter: int = 0, seed: Column | int = 0) -> Column:
    """Events (pos, ratio, skip_forbid, pred, hint) as (pos, tokens), in order, for ``frames_of_events``.

    An event's tokens are its hint if that is complete (ratio 1), else its prediction; with ``hint_only`` the hint
    alone. Events without tokens, or outside [0, n), are dropped, and of those that may be skipped (skip_forbid 0) a share
    ``skip``. Up to ``jitter`` frames are added to a place, after which it must still be inside. Choices come from a hash of
    seed, place and number of the event, so they are the same in every run.
    """
    only = hint_only if isinstance(hint_only, Column) else F.lit(hint_only)
    share = skip if isinstance(skip, Column) else F.lit(float(skip))
    part = lambda i, e, what: F.pmod(F.xxhash64(_i(seed), F.lit(what), e["pos"], i), F.lit(1 << 20))

    def one(e: Column, i: Column) -> Column:
        full = (e["ratio"] >= 1.0) & (F.size(e["hint"]) > 0)
        tokens = F.when(only | full, e["hint"]).otherwise(e["pred"])
        skipped = (e["skip_forbid"] == 0) & (part(i, e, "skip") < share * (1 << 20))
        pos = (e["pos"] + (part(i, e, "jitter") % (jitter + 1) if jitter else F.lit(0))).cast("int")
        ok = (e["pos"] >= 0) & (e["pos"] < _i(n)) & (pos < _i(n)) & ~skipped & (F.size(tokens) > 0)
        return F.struct(F.coalesce(ok, F.lit(False)).alias("ok"), pos.alias("pos"), tokens.alias("tokens"))

    kept = F.filter(F.transform(sorted_events(events), one), lambda x: x["ok"])
    return F.transform(kept, lambda x: F.struct(x["pos"].alias("pos"), x["tokens"].alias("tokens")))


def shift_within(stream: Column, by: Column | int, pad: int) -> Column:
    """``shifted`` by at least 1 and at most one less than the length, to the side of the sign of ``by``; streams of up to one frame stay."""
    n = F.size(stream)
    s = F.greatest(F.lit(1), F.least(F.abs(_i(by)), n - 1))
    return F.when(n <= 1, stream).otherwise(shifted(stream, F.when(_i(by) >= 0, s).otherwise(-s), pad))


def padded(streams: Column, length: Column | int, zero: int) -> Column:
    return F.transform(streams, lambda s: F.concat(s, repeat(zero, _i(length) - F.size(s))))


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, v: s + v)


def unit(a: Column) -> Column:
    """The vector at length 1; a zero vector stays."""
    n = F.sqrt(dot(a, a))
    return F.when(n > 0, F.transform(a, lambda x: x / n)).otherwise(F.transform(a, lambda x: x.cast("double")))


def last_phrase(words: Column, phrase: Column) -> Column:
    """0-based place of the last occurrence of a phrase in a list of words; null without one."""
    n, m = F.size(words), F.size(phrase)
    at = F.filter(F.sequence(F.lit(0), F.greatest(n - m, F.lit(0))), lambda i: part(words, i, m) == phrase)
    return F.when((m > 0) & (n >= m), F.array_max(at))
