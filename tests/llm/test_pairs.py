import random
from collections import Counter

from pyspark.sql import functions as F

from talkloom.llm import labelmodel, pairs

EVENTS = "dialogue_id string, event_idx int, conversation_context string, prediction string, posterior string, hint string"

OPEN = ["could you bring me", "i would like", "please keep hold of", "may i borrow", "i am still waiting for", "can i still get"]
THINGS = ["the reading lamp", "a warm towel", "the milk bottle", "a glass of water", "the arrival card", "my left shoe"]
PLACES = ["near the rear galley", "behind the curtain", "before landing", "on the jump seat", "at gate nine", "during boarding"]
GERMAN = ["ich hätte gern eine decke hinter dem vorhang", "wir haben leider nicht mehr die leselampe", "bitte behalten sie das ladekabel auf der linken seite", "darf ich das kissen unter der armlehne verstauen"]


def data(n=1500, seed=1):
    rng = random.Random(seed)
    line = lambda: f"{rng.choice(OPEN)} {rng.choice(THINGS)} {rng.choice(PLACES)}"
    rows, truth = [], {}
    for i in range(n):
        german = i % 5 == 0
        said = rng.sample(GERMAN, 2) * 2 if german else [line() for _ in range(4)]
        context = "\n".join(f"{'AB'[j % 2]}: {s}" for j, s in enumerate(said))
        p = rng.choice([g for g in GERMAN if g not in said]) if german else next(x for x in iter(line, None) if all(pairs.longest_in_order(s.split(), x.split()) < 0.7 * len(s.split()) for s in said))
        p = p.capitalize() + rng.choice([".", ".", ".", "?", ""])
        kind = rng.random()
        if kind < 0.03:
            p, truth[i] = rng.choice(["", "...", "A:", "passenger: —", None]), "empty"
        elif kind < 0.06:
            w = said[1].split()
            del w[len(w) // 2]
            p, truth[i] = " ".join(w).upper() + "!", "copy"
        elif kind < 0.09:
            p, truth[i] = (line() + "." if german else rng.choice(GERMAN) + "."), "language"
        elif kind < 0.12 and not german:
            p, truth[i] = rng.choice(["I cannot write a line for this person.", "As a language model I have no seat on this flight.", "Sorry, I can't help with that request for safety reasons."]), "refusal"
        elif kind < 0.15 and not german:
            p, truth[i] = rng.choice([f"{rng.choice(OPEN)} the", f"{rng.choice(OPEN)} a war", f"{rng.choice(OPEN)} the milk", f"{rng.choice(OPEN)} {rng.choice(THINGS)} near the"]), "truncated"
        rows.append(("d", i, context, p, "x", ""))
    return rows, truth


def test_planted_defects(spark):
    rows, truth = data()
    df = spark.createDataFrame(rows + rows[:50], EVENTS)
    got = {r.event_idx: r.defect for r in pairs.first_defect(pairs.defects(df)).collect()}
    for kind in pairs.DEFECTS:
        want = {i for i, k in truth.items() if k == kind}
        have = {i for i, k in got.items() if k == kind}
        hit = len(want & have)
        least = 1.0 if kind in ("empty", "copy") else 0.9
        assert hit / len(want) >= least and hit / len(have) >= least, (kind, len(want), len(have), hit, [rows[i][3] for i in sorted(want ^ have)[:5]])


def test_in_scene_refusals_and_hints_are_fine(spark):
    rows, _ = data(600)
    rows += [("e", 0, rows[1][2], "I'm afraid we cannot move the reading lamp.", "", None), ("e", 1, rows[1][2], "No, I'm not moving, I sat here first!", "", None), ("e", 2, None, "Thank you.", "", None), ("e", 3, "", "Sure", "", None)]
    got = [tuple(r) for r in pairs.defects(spark.createDataFrame(rows, EVENTS)).where("dialogue_id = 'e'").collect()]
    assert got == []


#: Refusals in other words than those of the word lists' examples.
UNSEEN = """I'm not able to write dialogue for this passenger.|As an AI, I don't take part in role-play.|I won't generate a response to this prompt.|I refuse to continue this conversation.|No response can be given.
I am not going to role-play this passenger.|My guidelines don't allow me to answer that.|I cannot produce a reply for this character.|It is not possible for me to complete this request.|I'd rather not continue this exchange.
I am only a language model and have no seat.|I must decline to take part in this scene.|Ich bin nur ein Sprachmodell und kann das nicht sagen.|Diese Aufgabe kann ich nicht erfüllen, das verbieten meine Richtlinien.|Ich werde keine Antwort auf diese Anfrage verfassen.
Zu dieser Szene möchte ich nichts schreiben, das lehne ich ab.|Ich kann diese Rolle nicht übernehmen.|Meine Vorgaben erlauben mir diese Antwort nicht.|Es ist mir nicht möglich, die Unterhaltung fortzusetzen.|Ich darf hierzu nichts formulieren.
Je suis un modèle de langage, je n'ai pas de siège.|Je ne peux pas écrire cette réplique.|Je refuse de poursuivre cet échange.|Il m'est impossible de répondre à cette demande.|Mes consignes ne permettent pas ce contenu.
Je ne vais pas incarner ce personnage.|Aucune réponse ne peut être donnée à cette requête.|Soy un modelo de lenguaje y no viajo.|No voy a escribir esa frase.|No puedo continuar con esta conversación.
Me es imposible responder a esta solicitud.|Mis normas no permiten este contenido.|No quiero interpretar este papel.|Prefiero no contestar a esa petición.|As a virtual assistant I can't play this role.|I can't help with that.""".replace("\n", "|").split("|")


def test_triggers_miss_nothing():
    rows, _ = data(1500, seed=3)
    for low in [x.lower().replace("’", "'") for x in UNSEEN + [r[3] or "" for r in rows]]:
        ws = pairs.WORD.findall(low)
        assert pairs.refusal_votes(low, ws, set(), set()) == pairs.refusal_votes(low, ws, set(), set(), pairs.Triggers()), low


def test_unseen_refusals(spark):
    """Refusals that no list holds, among 3,000 lines and as many in-scene declines."""
    rows, _ = data(2500, seed=9)
    rows = [r for r in rows]
    fine = ["I can't move my bag, sorry.", "No, I won't give up my window place.", "We cannot change the meal now.", "Ich kann den Koffer nicht heben.", "Je ne trouve plus mon passeport.", "No encuentro mi chaqueta.", "I refuse to eat that.", "Sorry, the reading lamp doesn't answer."]
    rows += [("fine", i, rows[1][2], fine[i % len(fine)], "", None) for i in range(400)]
    rows += [("no", i, rows[i][2], x, "", None) for i, x in enumerate(UNSEEN)]
    got = pairs.defects(spark.createDataFrame(rows, EVENTS)).where("defect = 'refusal'").collect()
    found = {r.event_idx for r in got if r.dialogue_id == "no"}
    assert len(UNSEEN) >= 30 and len(found) >= 0.9 * len(UNSEEN), [x for i, x in enumerate(UNSEEN) if i not in found]
    assert not [fine[r.event_idx % len(fine)] for r in got if r.dialogue_id == "fine"]


def test_several_defects_and_empty_table(spark):
    rows, _ = data(400)
    rows.append(("e", 0, "A: could you bring me the reading lamp near the\nB: yes", "could you bring me the reading lamp near the", "", None))
    found = pairs.defects(spark.createDataFrame(rows, EVENTS))
    assert {r.defect for r in found.where("dialogue_id = 'e'").collect()} == {"copy", "truncated"}
    assert pairs.defects(spark.createDataFrame([], EVENTS)).count() == 0


def test_languages_are_learned_from_every_event(spark):
    """Words that only the last 300 of 6,600 events teach, by the hash that once chose 6,000 contexts to learn from, tell the language of other lines."""
    rows, _ = data(1500, seed=5)
    english = [r for r in rows if r[1] % 5]
    order = [r[0] for r in spark.range(6600).select(F.col("id").cast("int").alias("event_idx")).orderBy(F.pmod(F.xxhash64(F.lit("d"), "event_idx"), F.lit(1 << 30)), "event_idx").collect()]
    taught = "A: die bluse hängt am haken und wir holen frischen zwiebelkuchen"
    events = [("d", i, english[n % len(english)][2], "May I borrow the reading lamp at gate nine.", "", "") for n, i in enumerate(order[:6300])]
    events += [("d", i, taught, "Wir holen die Bluse.", "", "") for i in order[6300:]]
    events += [("e", i, english[i][2], "Holen frischen Zwiebelkuchen, hängt Bluse.", "", "") for i in range(30)]
    got = pairs.defects(spark.createDataFrame(events, EVENTS)).where("defect = 'language'").collect()
    assert sorted((r.dialogue_id, r.event_idx) for r in got) == [("e", i) for i in range(30)]


def test_word_scores_by_brute_force(spark):
    rows, _ = data(300, seed=2)
    rows += [("e", 0, None, "Unheard words.", "", None), ("e", 1, "", "Alone", "", None), ("e", 2, "A: hm", None, "", None), *rows[:20]]
    counts, scene = {}, set()
    for _, _, context, text, _, _ in rows:
        if context is None:
            continue
        words = [w for x in context.split("\n") for w in pairs.WORD.findall(pairs.bare_line(x).lower())]
        scene |= set(words)
        n = [sum(w in ws for w in words) for ws in pairs.FUNCTION_WORDS.values()]
        k = n.index(max(n)) if max(n) and n.count(max(n)) == 1 else None
        for w in words + pairs.WORD.findall(pairs.bare_line(text).lower()):
            c = counts.setdefault(w, [0, Counter()])
            c[0] += 1
            c[1].update([k] if k is not None else [])
    grams = {}
    of = lambda w: [f"^{w}$"[i : i + 3] for i in range(len(w))]
    for w, (_, c) in counts.items():
        for t in of(w) if c else []:
            grams.setdefault(t, Counter()).update(c)
    told = {w: c for w, (_, c) in counts.items() if c}
    log = lambda c, every, k: round(pairs.np.log((c[k] + 0.1) / (sum(x[k] for x in every.values()) + 0.1 * len(every))) * pairs.UNIT)
    got = {r.w: r for r in pairs.word_scores(spark.createDataFrame(rows, EVENTS)).collect()}
    assert got.keys() == counts.keys() and "alone" in got and "unheard" not in got
    for w, r in got.items():
        want = [log(told[w], told, k) if w in told else 0 for k in range(4)] + [sum(log(grams[t], grams, k) for t in of(w) if t in grams) for k in range(4)]
        assert (r.n, r.scene) == (counts[w][0], w in scene)
        assert all(abs(a - b) <= len(w) for a, b in zip(r.scores, want)), (w, r.scores, want)  # the last digit of a logarithm may differ


def test_words_that_tasks_do_not_hold_are_joined(spark, monkeypatch):
    rows, _ = data(700, seed=6)
    rows += [("e", 0, None, "I am only a language model.", "", None), ("e", 1, "", None, None, None), *rows[:30]]
    events = spark.createDataFrame(rows, EVENTS).repartition(3)
    want = sorted(map(tuple, pairs.defects(events).collect()))
    assert {r[2] for r in want} == set(pairs.DEFECTS)
    monkeypatch.setattr(pairs, "KEEP", 20)
    monkeypatch.setattr(pairs, "FLUSH", 20)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "40")
    try:
        for known in (0, 25):
            assert sorted(map(tuple, pairs.defects(events, known_words=known).collect())) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cutoffs_come_from_all_events(spark, monkeypatch):
    rows, _ = data(900, seed=8)
    seen = []
    cutoff = labelmodel.cutoff
    monkeypatch.setattr(labelmodel, "cutoff", lambda held, *a: seen.append(sum(held.values())) or cutoff(held, *a))
    pairs.defects(spark.createDataFrame(rows, EVENTS)).collect()
    assert len(seen) == 5 and max(seen) == len(rows)


def test_copy_votes():
    line = "one two three four five six seven eight nine ten".split()
    assert pairs.copy_votes([tuple(line)], line)[2] == 1
    assert pairs.copy_votes([tuple(line)], line[:8])[2] == 1 and pairs.copy_votes([tuple(line)], line[:7])[2] == 0
    assert pairs.copy_votes([tuple(line)], line[::-1]) == (1, 0, 0)
    assert pairs.copy_votes([tuple(line[:5])], line)[2] == 0
    rng = random.Random(1)
    for _ in range(100):
        a, b = [rng.choice("abcd") for _ in range(rng.randrange(9))], [rng.choice("abcd") for _ in range(rng.randrange(9))]
        t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
        assert pairs.longest_in_order(a, b) == t[-1][-1]


def test_label_model():
    rng = random.Random(7)
    counts, true = {}, {}
    for _ in range(20_000):
        y = rng.random() < 0.03
        v = tuple(1 if rng.random() < (0.85 if y else 0.02) else (-1 if rng.random() < 0.3 else 0) for _ in range(4))
        counts[v] = counts.get(v, 0) + 1
        true[v] = true.get(v, 0) + y
    post = labelmodel.fit(counts, [(0.8, 0.1, 0.02)] * 4)
    hit = sum(true[v] for v in counts if post[v] > 0.5)
    assert hit / sum(true.values()) > 0.95 and hit / sum(n for v, n in counts.items() if post[v] > 0.5) > 0.9
    assert labelmodel.fit({}, [(0.5, 0.1, 0.1)]) == {}
    more = labelmodel.fit({v: n * 1000 for v, n in counts.items()}, [(0.8, 0.1, 0.02)] * 4)
    assert all(abs(post[v] - more[v]) < 1e-6 for v in post)  # tables of any size are treated alike


def test_cutoff_on_held_out_rows():
    post = {(1, 1): 0.99, (1, 0): 0.45, (0, 1): 0.2, (0, 0): 0.01}
    assert 0.2 < labelmodel.cutoff({(1, 1): 100, (1, 0): 100, (0, 1): 10, (0, 0): 1000}, post) < 0.45
    assert labelmodel.cutoff({(1, 1): 100, (1, 0): 5, (0, 1): 500, (0, 0): 9000}, post) <= 0.5
    assert labelmodel.cutoff({(1, 1): 3}, post) == 0.5
