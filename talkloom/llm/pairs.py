"""Broken prompt and response pairs: defects of predicted lines, by voting functions and a label model."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from talkloom.llm import labelmodel
from talkloom.session import checkpointed

#: Defects in the order in which the first that applies is reported.
DEFECTS = ["empty", "copy", "language", "refusal", "truncated"]
#: Words whose scores are sent to all tasks, at most, the most frequent first; those of all others are joined to the events that have them.
KNOWN_WORDS = 200_000
#: Scores are whole numbers of this part of one, so that no sum depends on an order.
UNIT = 1 << 20
#: A copy has this share of the words of a line of at least so many words, in the same order.
COPY_SHARE, COPY_WORDS = 0.8, 6
#: A word that ends no finished text and is seen less often than this counts as rare.
RARE = 5
#: Distinct word pairs that a task counts before it writes them out.
FLUSH = 200_000

# Function words of the languages, by which a language is told and after which a line can't end.
FUNCTION_WORDS = {
    "en": "the a an i you he she it we they to of is are was were for my your his her our their and or but because since in on at by with from as that this be have has had can could will would may do did not no if when who some any very".split(),
    "de": "der die das den dem des ein eine einen einem einer ich du er sie es wir und oder aber denn weil mit für von vom im am zum zur bei nach auf unter neben zwischen mein meine nicht ist sind war hat habe haben kann noch zu sehr kein keine mir wer".split(),
    "fr": "le la les un une des du de je tu il elle nous vous et ou mais car parce que qui mon ma mes pour avec dans sur sous à au aux en par ne pas est sont était ce cette très plus votre on".split(),
    "es": "el la los las un una unos y o pero pues porque que de del al en con para por mi mis su se no es son está era me le lo nos muy más yo usted esta este quién sin".split(),
}
OPEN_WORDS = {
    "en": "the a an of to for with from my your his her our their and or but because since between at by into is are was the's very i we who that when if while than".split(),
    "de": "der die das den dem des ein eine einen einem einer und oder aber denn weil mit für von vom im am zum zur bei mein meine zu ich wir dass wenn ob".split(),
    "fr": "le la les un une des du de et ou mais car que qui mon ma mes pour avec dans sur sous à au aux en par ne je nous très si quand".split(),
    "es": "el la los las un una unos y o pero pues porque que de del al en con para por mi mis su se muy si cuando".split(),
}
# Word stems and phrases by which a refusal is told, in four languages: who speaks (a model, its rules); that something isn't done; what
# would be done (words for producing text); what it would be done to (the task, the text, the role); regret or sending on.
NAMES_ITSELF = (
    r"language model|\ban? ai\b|\bai (?:model|system)|\bassistant\b|chatbot|artificial|\bprogrammed|\bguidelines\b|\bpolic(?:y|ies)\b|my (?:rules|instructions|safety)"
    r"|sprachmodell|künstliche|\bki\b|assistent|richtlinien|programmiert|vorgaben|meine (?:regeln|anweisungen)"
    r"|modèle de lang|intelligence artificielle|assistant|consignes|directives|programmé|mes règles"
    r"|modelo de lenguaje|inteligencia artificial|asistente|\bnormas\b|directrices|políticas|programad"
)
DENIES = (
    r"\b(?:can't|cannot|can not|couldn't|won't|will not|unable|not able|not going to|refuse|declin\w*|not allowed|not permitted|not possible|impossible|not comfortable|rather not|not appropriate|no|not|don't|do not)\b"
    r"|\b(?:nicht|kein\w*|ablehn\w*|lehne|verweiger\w*|unmöglich|außerstande)\b|\b(?:ne|n'\w+|refus\w*|impossible|incapable|décline\w*|aucune?)\b"
    r"|\b(?:no|niego|negarme|rechaz\w*|imposible|incapaz|ningun[ao]?|ningún)\b"
)
PRODUCES = (
    r"\b(?:writ(?:e|ing)|generat(?:e|ing)|produc(?:e|ing)|respond(?:ing)?|reply(?:ing)?|answer(?:ing)?|continu(?:e|ing)|role-?play\w*|impersonat\w+|portray\w*|comply(?:ing)?|fulfil\w*|creat(?:e|ing)|compos(?:e|ing)|mak(?:e|ing) up|speak(?:ing)? (?:for|as)|act as|engag(?:e|ing)|help with (?:that|this)|provide (?:that|this|an?|any))\b"
    r"|\b(?:\w*schreiben|verfassen|erzeugen|generieren|\w*antworten|fort(?:zu)?setzen|fort(?:zu)?führen|weiter(?:zu)?führen|formulieren|erstellen|mitmachen|(?:dabei|damit) helfen)\b"
    r"|\b(?:écrire|rédiger|générer|produire|répondre|continuer|poursuivre|incarner|jouer|formuler|inventer|aider (?:avec|à|pour) (?:ça|cela|ce))\b"
    r"|\b(?:escribir|redactar|generar|producir|responder|contestar|continuar|interpretar|seguir con|formular|inventar|ayudar(?:te|le)? (?:con|en) (?:eso|esto))\b"
)
# A refusal of everything, without saying of what.
OUTRIGHT = (
    r"\b(?:have to|must|need to|will|i) decline\b|\bdeclin(?:e|ing) to (?:do|say|take|be|go)\b|\bi(?:'ll| will)? (?:decline|refuse)[.,!]|\bnot something i (?:can|will|do)\b|\bi'm not going to do (?:that|this)\b|\b(?:can't|cannot) help (?:you )?with (?:that|this)\b"
    r"|\bmuss (?:ich )?(?:\w+ )?ablehnen|\b(?:das|dies) lehne ich ab|\blehne (?:ich )?(?:das|dies) ab|\bdabei kann ich (?:ihnen )?nicht helfen|\bdabei helfe ich nicht"
    r"|\b(?:je )?(?:dois|préfère) (?:refuser|décliner)|\bje (?:refuse|décline)[.,!]|\bne peux pas (?:vous )?aider (?:avec|sur|à) (?:ça|cela|ce)"
    r"|\b(?:debo|tengo que|prefiero) (?:negarme|rechazar|declinar)|\bme niego[.,!]|\bno puedo ayudar(?:te|le)? (?:con|en) (?:eso|esto)"
)
THE_TASK = (
    r"\b(?:this|that|the|your|such|any|no|a) (?:\w+ )?(?:requests?|prompts?|conversation|dialogue|exchange|reply|replies|response|line|lines|scene|role|character|persona|content|task|instructions?)\b|\bthis passenger\b|line for (?:this|them)"
    r"|\b(?:dies\w*|d(?:er|ie|as|em)|solche\w*|(?:k?ein)\w*|ihre) (?:\w+ )?(?:anfrage|aufforderung|unterhaltung|dialog\w*|antwort|zeile|szene|rolle|figur|inhalt\w*|aufgabe)\b|etwas zu schreiben"
    r"|\b(?:cet(?:te)?|ce|l[ae]|votre|une?|aucune?) (?:demande|requête|conversation|échange|dialogue|réponse|réplique|scène|rôle|personnage|contenu|tâche)\b|\bl'échange\b"
    r"|\b(?:es[at]a?|este|ese|la|el|una?|ninguna|tal) (?:petición|solicitud|conversación|diálogo|intercambio|respuesta|réplica|línea|frase|escena|papel|personaje|contenido|tarea)\b"
)
SENDS_ON = (
    r"\b(?:something|anything) else|at this point|safety reasons|\betwas anderes|an dieser stelle|sicherheitsgründen|autre chose|à ce stade|raisons de sécurité|otra cosa[.!]*$|en este punto|motivos de seguridad"
    r"|^\W*(?:i'm sorry, but|sorry, (?:but )?i|i am sorry|i must be clear|apologies|unfortunately|es tut mir leid|leider|entschuldigung|je suis désolée?|désolée?|malheureusement|lo siento|lamentablemente|perdón)"
)
_NAMES, _DENIES, _TASK, _SENDS = (re.compile(p) for p in (NAMES_ITSELF, DENIES, THE_TASK, SENDS_ON))
#: Production that is denied, up to five words before, or called impossible behind.
_DENIED = re.compile(rf"{OUTRIGHT}|(?:{DENIES})(?:\W+\w+){{0,5}}?\W+(?:{PRODUCES})|(?:{PRODUCES})(?:\W+\w+){{0,4}}?\W+(?:not possible|impossible|unmöglich|imposible)\b")

#: A word without which none of the patterns can match: one of these begins it. Lines without any aren't searched.
TRIGGERS = tuple(
    "language ai assistant chatbot artificial programmed guideline polic rules instruction safety sprachmodell künstliche ki assistent richtlinien programmiert vorgaben regeln anweisungen modèle intelligence consignes "
    "directives programmé règles modelo inteligencia asistente normas directrices políticas programad writ generat produc respond repl answer continu role impersonat portray compl fulfil creat compos mak speak act engag "
    "help provid declin refus something going muss ablehnen lehne dabei damit dois préfère debo tengo prefiero niego erzeug generier fort weiter formul erstell mitmach verfass écri rédig génér répond poursui incarn jouer "
    "invent aid escrib redact gener contest interpret seguir ayud request prompt conversation dialog exchange response line scene character persona content task passenger anfrage aufforderung unterhaltung zeile szene rolle "
    "figur inhalt aufgabe demande requête échange réponse réplique scène rôle personnage contenu tâche petición solicitud conversación diálogo intercambio respuesta réplica línea frase escena papel personaje contenido tarea "
    "else anything point etwas stelle sicherheits autre stade raisons otra punto motivos sorry clear apolog unfortunately leid leider entschuldigung désolé malheureusement siento lamentablemente perdón".split()
)
#: German verbs of producing text with a prefix end so.
TRIGGER_ENDS = ("schreiben", "antworten")

WORD = re.compile(r"[^\W_]+")
TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*")
DIGITS = re.compile(r"\d+")
LABEL = re.compile(r"^\s*[\[(]?(?:a|b|crew|passenger|speaker [ab])[\])]?\s*:", re.I)
CLAUSE = re.compile(r"[.?!;:…]+")
SENTENCE = re.compile(r"([^.?!…]+)([.?!…]*)")


def bare_line(text: str | None) -> str:
    """A line without its speaker label."""
    return LABEL.sub("", text, count=1) if text and ":" in text else text or ""


def longest_in_order(line: list[str], pred: list[str]) -> int:
    """Length of the longest common subsequence, by bit vectors."""
    at: dict[str, int] = {}
    for i, x in enumerate(pred):
        at[x] = at.get(x, 0) | 1 << i
    full = (1 << len(pred)) - 1
    v = full
    for x in line:
        u = v & at.get(x, 0)
        v = ((v + u) | (v - u)) & full
    return len(pred) - v.bit_count()


def copy_votes(lines: list[tuple[str, ...]], pred: list[str]) -> tuple[int, int, int]:
    """Votes on a copy: enough of a line's words at all, four in a row, and enough in the same order."""
    have = set(pred)
    bag = row = order = 0
    grams = None
    for w in lines:
        n = len(w)
        if n < COPY_WORDS or len(pred) < COPY_SHARE * n or sum(map(have.__contains__, w)) < COPY_SHARE * n:
            continue
        bag = 1
        grams = grams if grams is not None else set(zip(pred, pred[1:], pred[2:], pred[3:]))
        row = row or int(any(g in grams for g in zip(w, w[1:], w[2:], w[3:])))
        order = order or int(longest_in_order(list(w), pred) >= COPY_SHARE * n)
    return bag, row, order


NAMES = list(FUNCTION_WORDS)
_STOP = [set(ws) for ws in FUNCTION_WORDS.values()]
_LANGUAGES = "w string, n bigint, " + ", ".join(f"{g} bigint" for g in NAMES) + ", scene boolean"


def _flat(lists: Sequence[Sequence[int]]) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of the lists, and the lists' sizes."""
    sizes = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
    return np.fromiter(chain.from_iterable(lists), dtype=np.int64, count=int(sizes.sum())), sizes


def _sums(lists: Sequence[Sequence[int]], table: np.ndarray) -> np.ndarray:
    """Sums of the table's rows over each list."""
    flat, sizes = _flat(lists)
    out = np.zeros((len(lists), table.shape[1]), dtype=np.int64)
    if len(flat):
        full = np.flatnonzero(sizes)
        out[full] = np.add.reduceat(table[flat], np.concatenate([[0], np.cumsum(sizes[full])[:-1]]), axis=0)
    return out


def _count_words(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Counts of the words of contexts and predictions by the language that the context's function words tell, and whether a context has them.

    A line that many contexts share is read once; its words count as often as it occurs.
    """
    lines: dict[str, int] = {}
    place: dict[str, int] = {}
    line_words: list[list[int]] = []
    stops = by_line = by_word = np.zeros((0, 0), dtype=np.int64)

    def empty() -> None:
        nonlocal stops, by_line, by_word
        for x in (lines, place, line_words):
            x.clear()
        stops, by_line, by_word = (np.zeros((0, len(NAMES) + k), dtype=np.int64) for k in (0, 1, 1))

    def ids(text: str) -> list[int]:
        ws = WORD.findall(bare_line(text).lower())
        try:
            return [place[w] for w in ws]
        except KeyError:
            return [place.setdefault(w, len(place)) for w in ws]

    def longer(table: np.ndarray, n: int) -> np.ndarray:
        return np.concatenate([table, np.zeros((n - len(table), table.shape[1]), dtype=np.int64)])

    def flush() -> pd.DataFrame:
        flat, sizes = _flat(line_words)
        scene = np.zeros(len(place), dtype=bool)
        scene[flat] = True
        np.add.at(by_word, flat, np.repeat(by_line, sizes, axis=0))
        out = pd.DataFrame({"w": list(place), "n": by_word.sum(axis=1), **{g: by_word[:, k + 1] for k, g in enumerate(NAMES)}, "scene": scene})
        empty()
        return out

    empty()
    for pdf in it:
        contexts, preds, fresh = [], [], len(line_words)
        for context, text in zip(pdf["conversation_context"], pdf["prediction"]):
            at = []
            for x in context.split("\n"):
                i = lines.get(x)
                if i is None:
                    i = lines[x] = len(line_words)
                    line_words.append(ids(x))
                at.append(i)
            contexts.append(at)
            preds.append(ids(text or ""))
        words = list(place)
        stops = longer(stops, len(line_words))
        by_line, by_word = longer(by_line, len(line_words)), longer(by_word, len(words))
        is_stop = np.array([[w in ws for ws in _STOP] for w in words], dtype=np.int64).reshape(-1, len(NAMES))
        stops[fresh:] = _sums(line_words[fresh:], is_stop)
        n = _sums(contexts, stops)
        top = n.max(axis=1, initial=0)
        told = np.where((top > 0) & ((n == top[:, None]).sum(axis=1) == 1), n.argmax(axis=1) + 1, 0)
        for lists, counts in ((contexts, by_line), (preds, by_word)):
            flat, sizes = _flat(lists)
            np.add.at(counts, (flat, np.repeat(told, sizes)), 1)
        if len(lines) > KEEP or len(place) > FLUSH:
            yield flush()
    if place:
        yield flush()


def word_scores(events: DataFrame) -> DataFrame:
    """(w, n, scores, scene) of every word of the events that have a context: how often it occurs, its scores, and whether a context has it.

    The scores are logarithms, by language, of the shares of the word and, summed, of its groups of three letters. They come from the counts
    of all events whose language the function words of the context tell; a word of none of these has scores of its groups only.
    """
    sums = [F.sum(g).alias(g) for g in NAMES]
    counted = events.where("conversation_context is not null").select("conversation_context", "prediction").mapInPandas(_count_words, _LANGUAGES)
    words = checkpointed(counted.groupBy("w").agg(F.sum("n").alias("n"), *sums, F.max("scene").alias("scene")))
    told = sum((F.col(g) for g in NAMES[1:]), F.col(NAMES[0])) > 0
    letters = F.concat(F.lit("^"), "w", F.lit("$"))
    t = F.explode(F.transform(F.sequence(F.lit(1), F.length("w")), lambda i: F.substring(letters, i, F.lit(3)))).alias("t")
    grams = checkpointed(words.where(told).select(t, *NAMES).groupBy("t").agg(*sums))

    def logs(counts: DataFrame) -> list:
        of = counts.agg(F.count(F.lit(1)).alias("size"), *sums).first()
        return [F.round(F.log((F.col(g) + 0.1) / ((of[g] or 0) + 0.1 * max(of["size"], 1))) * UNIT).cast("bigint") for g in NAMES]

    of_words = F.array(*[F.when(told, x).otherwise(0) for x in logs(words.where(told))])
    of_grams = [x.alias(f"of_{g}") for g, x in zip(NAMES, logs(grams))]
    by_grams = words.select(F.col("w").alias("gw"), t).join(grams.select("t", *of_grams), "t").groupBy("gw").agg(F.array(*[F.sum(f"of_{g}") for g in NAMES]).alias("of_grams"))
    none = F.array(*[F.lit(0).cast("bigint") for _ in NAMES])
    scored = words.join(by_grams, F.col("w") == F.col("gw"), "left")
    return checkpointed(scored.select("w", "n", F.concat(of_words, F.coalesce("of_grams", none)).alias("scores"), "scene"))


class Languages:
    """Scores of words in three models of the languages (words, groups of three letters, function words), and the words of the scene.

    Words can be added by ``learn``, until ``forget``.
    """

    def __init__(self, known: pd.DataFrame):
        self.place: dict[str, int] = {}
        self.table = np.zeros((1, 3 * len(NAMES)), dtype=np.int64)  # the first row is that of words without scores
        self.scene: set[str] = set()
        self.added: list[str] = []
        self.learn(zip(known["w"], known["scores"], known["scene"]))
        self.base, self.added = len(self.place), []

    def learn(self, rows: Iterable[tuple[str, Sequence[int], bool]]) -> None:
        new = {w: (scores, scene) for w, scores, scene in rows if w not in self.place}
        if new:
            self.place.update(zip(new, range(len(self.table), len(self.table) + len(new))))
            self.table = np.concatenate([self.table, np.array([[*scores, *(UNIT * (w in ws) for ws in _STOP)] for w, (scores, _) in new.items()], dtype=np.int64)])
            self.scene.update(w for w, (_, scene) in new.items() if scene)
            self.added += new

    def forget(self) -> None:
        self.scene.difference_update(self.added)
        for w in self.added:
            del self.place[w]
        self.table, self.added = self.table[: self.base + 1], []

    def ids(self, ws: Sequence[str]) -> list[int]:
        """Places of words in the table of scores."""
        return list(map(self.place.get, ws, repeat(0)))


#: By how much the best language must lead, by model.
MARGINS = (2.0, 3.0, 1.0)
#: Lines and words that a task keeps scores of before it begins anew.
KEEP = 50_000


def _best(scores: np.ndarray) -> np.ndarray:
    """Per row and model, the place of the largest score, or -1 if it isn't ahead of all others by the model's margin."""
    scores = scores.reshape(len(scores), len(MARGINS), -1)
    two = np.sort(scores, axis=2)[:, :, -2:]
    return np.where(two[:, :, 1] - two[:, :, 0] >= np.array(MARGINS) * UNIT, scores.argmax(axis=2), -1)


class Triggers(dict):
    """Whether a word is one without which no pattern matches; remembers the words it was asked for."""

    def __missing__(self, w: str) -> bool:
        if len(self) > KEEP:
            self.clear()
        got = self[w] = w.startswith(TRIGGERS) or w.endswith(TRIGGER_ENDS)
        return got


def refusal_votes(low: str, ws: list[str], scene: set[str], near: set[str], triggers: Triggers | None = None) -> str:
    """Votes on a refusal of a line in lower case with its words, the words of the scene, and the words of context and hint.

    Who speaks; denied production of text; a task or role that is denied; regret or sending on. Two more support these, as
    they say nothing alone of a line about the cabin that nobody said before: words that the scene doesn't know, and nothing in common
    with context and hint. ``triggers`` spares lines that can't match the search.
    """
    if triggers is not None and not any(map(triggers.__getitem__, ws)):
        named = denied = task = sends = False
    else:
        named, denied, sends = (p.search(low) is not None for p in (_NAMES, _DENIED, _SENDS))
        task = any(_TASK.search(x) is not None and _DENIES.search(x) is not None for x in CLAUSE.split(low)) if _TASK.search(low) else False
    content = [w for w in ws if len(w) > 3]
    some = named or denied or task
    new = len(content) - sum(map(scene.__contains__, content))
    out = "1" if some and new * 4 >= len(content) and new else "0" if content and not new else "x"
    own = "0" if not near.isdisjoint(content) else "1" if some and len(ws) > 3 else "x"
    return "".join(str(int(v)) for v in (named, denied, task, sends)) + out + own


_VOTES = "dialogue_id string, event_idx int, votes string, copied boolean, blank boolean, prev string, last string, open int, n bigint, ends bigint"


def _read(langs: Languages):
    opens = {w for ws in OPEN_WORDS.values() for w in ws}

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[tuple[str, str]] = Counter()
        ends: Counter[tuple[str, str]] = Counter()
        lines: dict[str, int] = {}
        words_of: list[tuple[str, ...]] = []
        triggers = Triggers()
        scores = np.zeros((0, langs.table.shape[1]), dtype=np.int64)

        def flush() -> pd.DataFrame:
            rows = [(None, None, None, None, None, *p, None, n, ends[p]) for p, n in counts.items()]
            counts.clear()
            ends.clear()
            return pd.DataFrame(rows, columns=_COLS)

        for pdf in it:
            if len(lines) > KEEP or len(langs.added) > KEEP:
                lines.clear()
                words_of.clear()
                langs.forget()
                scores = scores[:0]
            if "more" in pdf:
                langs.learn(_told(x) for xs in pdf["more"] if xs is not None for x in xs)
            contexts, lows, preds, fresh = [], [], [], len(words_of)
            for context, text in zip(pdf["conversation_context"], pdf["prediction"]):
                at = []
                for x in (context or "").split("\n"):
                    i = lines.get(x)
                    if i is None:
                        i = lines[x] = len(words_of)
                        words_of.append(tuple(WORD.findall(bare_line(x).lower())))
                    at.append(i)
                contexts.append(at)
                low = bare_line(text).lower().replace("’", "'")
                lows.append(low)
                preds.append(WORD.findall(low))
            if len(words_of) > fresh:
                scores = np.concatenate([scores, _sums([langs.ids(ws) for ws in words_of[fresh:]], langs.table)])
            theirs = _best(_sums(contexts, scores))
            ours = _best(_sums([langs.ids(ws) for ws in preds], langs.table))
            other = np.where((theirs < 0) | (ours < 0), "x", np.where(theirs != ours, "1", "0"))
            out, seen, ended = [], [], []
            for n, (d, k, hint, low, ws) in enumerate(zip(pdf["dialogue_id"], pdf["event_idx"], pdf["hint"], lows, preds)):
                if not ws:
                    out.append((d, k, "empty:11", False, True, None, None, None, None, None))
                    continue
                votes = ["empty:0" + ("1" if len(low.strip()) < 2 else "0")]
                known = [words_of[i] for i in contexts[n]]
                bag, row, order = copy_votes(known, ws)
                votes.append(f"copy:{bag}{row}{order}")
                v = other[n]
                votes.append("language:" + v[0] + ("x" if len(ws) < 3 else v[1]) + v[2])  # groups of letters of one or two words tell little
                near = set().union(*known, WORD.findall((hint or "").lower()))
                votes.append("refusal:" + refusal_votes(low, ws, langs.scene, near, triggers))
                prev = last = is_open = None
                sentences = SENTENCE.findall(low)
                as_words = len(sentences) == 1 and "'" not in low and "-" not in low
                digits = DIGITS.search(low) is not None
                for body, stop in sentences:
                    ts = ws if as_words else TOKEN.findall(body)
                    if not ts:
                        continue
                    if digits:
                        ts = [DIGITS.sub("#", t) for t in ts]
                    pairs = list(zip(["^", *ts], ts))
                    if not stop:
                        prev, last = pairs.pop()
                        is_open = -1 if len(ws) == 1 else int(ts[-1] in opens and len(ts) > 1)
                    else:
                        prev = last = is_open = None
                    seen += pairs
                    if stop:
                        ended.append(pairs[-1])
                out.append((d, k, " ".join(votes), bool(order), False, prev, last, is_open, None, None))
            counts.update(seen)
            ends.update(ended)
            yield pd.DataFrame(out, columns=_COLS)
            if len(counts) > FLUSH:
                yield flush()
        if counts:
            yield flush()

    return run


_COLS = [c.split()[0] for c in _VOTES.split(", ")]


def _ending_votes(pairs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Votes on the last pair of words of unfinished lines: (prev, last, w2, w3, w4) per distinct pair.

    w2: how often the pair (or, for a rare word, any rare word after prev) ends a finished sentence; w3: the
    same of the last word; w4: a rare last word that begins a word seen after prev. All from counts over
    all predictions.
    """
    pairs = checkpointed(pairs.groupBy("prev", "last").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends")))
    words = checkpointed(pairs.groupBy(F.col("last").alias("w")).agg(F.sum("n").alias("wn"), F.sum("ends").alias("we")))
    rare = F.col("wn") < RARE
    known = pairs.join(words, F.col("last") == F.col("w"))
    star = known.where(rare).groupBy(F.col("prev").alias("sp")).agg(F.sum("n").alias("sn"), F.sum("ends").alias("se"))
    starts = F.explode(F.transform(F.sequence(F.lit(1), F.length("last") - 1), lambda i: F.substring("last", 1, i))).alias("pl")
    prefix = known.where(~rare & (F.length("last") > 1) & (F.col("n") >= 2)).select(F.col("prev").alias("pp"), starts).distinct()
    any_starts = F.explode(F.transform(F.sequence(F.lit(1), F.length("w") - 1), lambda i: F.substring("w", 1, i))).alias("gl")
    anywhere = words.where(~rare & (F.length("w") > 1)).select(any_starts).distinct()
    x = (
        wanted.join(words, F.col("last") == F.col("w"), "left")
        .join(pairs.select(F.col("prev").alias("bp"), F.col("last").alias("bl"), F.col("n").alias("bn"), F.col("ends").alias("be")), (F.col("prev") == F.col("bp")) & (F.col("last") == F.col("bl")), "left")
        .join(star, F.col("prev") == F.col("sp"), "left")
        .join(prefix, (F.col("prev") == F.col("pp")) & (F.col("last") == F.col("pl")), "left")
        .join(anywhere, F.col("last") == F.col("gl"), "left")
    )
    is_rare = F.coalesce(F.col("wn"), F.lit(0)) < RARE
    rate = lambda e, n: F.coalesce(F.col(e), F.lit(0)) / F.col(n)
    w2 = (
        F.when(is_rare & (F.col("sn") >= RARE) & (rate("se", "sn") < 0.05), "1")
        .when(is_rare & (F.col("sn") >= RARE) & (rate("se", "sn") >= 0.1), "0")
        .when(~is_rare & (F.col("bn") >= RARE) & (rate("be", "bn") < 0.01), "1")
        .when(~is_rare & (F.col("bn") >= RARE) & (rate("be", "bn") >= 0.03), "0")
        .when(~is_rare & (F.col("be") > 0), "0")
        .otherwise("x")
    )
    w3 = F.when(is_rare, "x").when(rate("we", "wn") < 0.01, "1").when(rate("we", "wn") > 0.05, "0").otherwise("x")
    w4 = F.when(~is_rare | (F.col("prev") == "^"), "x").when(F.col("pp").isNotNull(), "1").when(F.col("gl").isNull(), "0").otherwise("x")
    return x.select("prev", "last", w2.alias("w2"), w3.alias("w3"), w4.alias("w4"))


def _told(x: str) -> tuple[str, list[int], bool]:
    """A word, its scores and whether it is of the scene, from text."""
    w, *scores, scene = x.split(" ")
    return w, [int(v) for v in scores], scene == "1"


def _with_rest(events: DataFrame, known: frozenset[str], scores: DataFrame) -> DataFrame:
    """Events with the scores of all their words that aren't known, as texts in ``more``; joined by what the texts say, so that an event that is delivered again is no other."""

    def rest(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in it:
            yield pd.DataFrame([(k, w) for k, c, p in zip(pdf["key"], pdf["conversation_context"], pdf["prediction"]) for w in {w for x in [*(c or "").split("\n"), p] for w in WORD.findall(bare_line(x).lower())} - known], columns=["key", "w"])

    text = F.concat(F.coalesce(F.length("conversation_context"), F.lit(0)).cast("string"), F.lit(":"), F.coalesce("conversation_context", F.lit("")), F.coalesce("prediction", F.lit("")))
    keyed = events.withColumn("key", F.md5(text))
    wanted = keyed.select("key", "conversation_context", "prediction").mapInPandas(rest, "key string, w string").distinct()
    said = F.concat_ws(" ", F.col("w"), F.col("scores").cast("array<string>"), F.col("scene").cast("int").cast("string"))
    more = wanted.join(scores.select("w", said.alias("said")), "w").groupBy("key").agg(F.collect_list("said").alias("more"))
    return keyed.join(more, "key", "left").drop("key")


#: Per voting function: expected shares of yes and of no on true cases, and of yes on false ones.
EXPECTED = {
    "empty": ((0.98, 0.01, 0.001), (0.6, 0.39, 0.001)),
    "copy": ((0.98, 0.01, 0.001), (0.8, 0.19, 0.01), (0.98, 0.01, 0.0001)),
    "language": ((0.9, 0.02, 0.005), (0.9, 0.02, 0.005), (0.8, 0.02, 0.005)),
    "refusal": ((0.4, 0.59, 0.0002), (0.7, 0.29, 0.001), (0.5, 0.49, 0.002), (0.5, 0.49, 0.03), (0.7, 0.1, 0.001), (0.8, 0.15, 0.001)),
    "truncated": ((0.5, 0.01, 0.0005), (0.7, 0.02, 0.005), (0.6, 0.05, 0.02), (0.3, 0.02, 0.003)),
}
#: Copies of the looked-up votes by which a hot last pair of words is spread over tasks.
SALTS = 16


def defects(events: DataFrame, cutoffs: dict[str, float] | None = None, known_words: int = KNOWN_WORDS) -> DataFrame:
    """(dialogue_id, event_idx, defect, posterior) of every defect of every event; an event may have several.

    Each defect has voting functions; patterns of votes are counted over all events, an expectation-maximisation
    label model turns each pattern into a posterior, and posteriors above the cutoffs are kept. A cutoff that isn't
    given is the one with the best expected F1 over all events, each half judged by a model that was fitted on the other. 'empty' and
    'copy' have an exact definition, which is checked afterwards. Events that are delivered again count once in
    the result. Null predictions and predictions without letter or digit are empty; without context a
    prediction is neither a copy nor in another language. An empty table gives no rows; further columns are
    ignored. The language models and the scene's words are counts over all events; ``known_words`` bounds only how
    many words' scores all tasks get, others are joined to their events, and the result is the same.
    """
    cutoffs = cutoffs or {}
    e = events.select("dialogue_id", "event_idx", "conversation_context", "prediction", "hint")
    scores = word_scores(e)
    first = scores.orderBy(F.desc("n"), "w").limit(known_words + 1).toPandas()
    langs = Languages(first[:known_words])
    if len(first) > known_words:
        e = _with_rest(e, frozenset(langs.place), scores)
    read = checkpointed(e.mapInPandas(_read(langs), _VOTES))
    rows = read.where("votes is not null")
    pairs = read.where("votes is null")

    # Endings: the votes on each distinct last pair, spread by salt for pairs that many lines share.
    unfinished = rows.where("last is not null")
    ends = _ending_votes(pairs.select("prev", "last", "n", "ends"), unfinished.select("prev", "last").distinct())
    ends = ends.select(F.col("prev").alias("ep"), F.col("last").alias("el"), "w2", "w3", "w4", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("es"))
    salt = F.pmod(F.hash("dialogue_id", "event_idx"), F.lit(SALTS))
    on = (F.col("prev") == F.col("ep")) & (F.col("last") == F.col("el")) & (F.col("salt") == F.col("es"))
    open_vote = F.when(F.col("open") == 1, "1").otherwise("x")
    voted = rows.withColumn("salt", salt).join(ends, on, "left")
    tail = F.when(F.col("last").isNotNull() & (F.col("open") >= 0), F.concat(F.lit(" truncated:"), open_vote, F.coalesce("w2", F.lit("x")), F.coalesce("w3", F.lit("x")), F.coalesce("w4", F.lit("x")))).otherwise("")
    voted = checkpointed(voted.select("dialogue_id", "event_idx", "copied", "blank", F.explode(F.split(F.concat("votes", tail), " ")).alias("vote")))

    # Patterns: at most 3 to the power of the functions per defect, whatever the number of events. For a cutoff
    # that isn't given, each half of the events, by a hash, is judged by the model that the other half fits.
    half = F.pmod(F.xxhash64("dialogue_id", "event_idx"), F.lit(2))
    patterns: dict[str, tuple[Counter, Counter]] = {}
    for r in voted.groupBy("vote", half.alias("half")).count().collect():
        name, v = r["vote"].split(":")
        patterns.setdefault(name, (Counter(), Counter()))[r["half"]][tuple(labelmodel.ABSTAIN if c == "x" else int(c) for c in v)] += r["count"]
    keep = []
    for name, (a, b) in patterns.items():
        judged = [(k, held, labelmodel.fit(fitted or held, EXPECTED[name], also=held)) for k, (fitted, held) in enumerate(((a, b), (b, a)))]
        counts = {(k, *v): n for k, held, _ in judged for v, n in held.items()}
        cut = cutoffs[name] if name in cutoffs else labelmodel.cutoff(counts, {(k, *v): part[v] for k, held, part in judged for v in held})
        for v, p in labelmodel.fit(a + b, EXPECTED[name]).items():
            if p > cut and labelmodel.YES in v:  # where nobody says yes, nothing is found
                keep += [F.lit(f"{name}:" + "".join("x" if x < 0 else str(x) for x in v)), F.lit(float(p))]
    if not keep:
        return voted.where("false").select("dialogue_id", "event_idx", F.lit("").alias("defect"), F.lit(0.0).alias("posterior"))
    found = voted.withColumn("posterior", F.try_element_at(F.create_map(*keep), F.col("vote"))).where("posterior is not null")
    found = found.withColumn("defect", F.substring_index("vote", ":", 1))
    exact = ((F.col("defect") != "copy") | F.col("copied")) & ((F.col("defect") != "empty") | F.col("blank"))
    return found.where(exact).groupBy("dialogue_id", "event_idx", "defect").agg(F.max("posterior").alias("posterior"))


def first_defect(found: DataFrame) -> DataFrame:
    """One row (dialogue_id, event_idx, defect) per defective event: the first defect in order."""
    rank = F.array_position(F.array(*[F.lit(d) for d in DEFECTS]), F.col("defect"))
    return found.groupBy("dialogue_id", "event_idx").agg(F.min_by("defect", rank).alias("defect"))
