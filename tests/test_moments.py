"""The moment gate against a plain loop: all errors of each moment, counts and coverage that agree."""

import random
from collections import Counter

from test_fuzzy import brute_quote

from quillstone.functions import moments as M


def brute(m, frames, duration, transcript):
    errors = []
    ids = m["frame_ids"] or []
    missing = [f for f in ids if (m["video_id"], f) not in frames]
    if not ids:
        errors.append(("frame_existence", "No frame IDs specified"))
    elif missing:
        errors.append(("frame_existence", "Missing frames: " + ", ".join(map(str, missing))))
    segments = [s for s in transcript if s[0] == m["video_id"]]
    cues, stamps = m["audio_cues"] or [], m["timestamps"] or []
    if not cues:
        errors.append(("transcript_match", "No audio cues specified"))
    elif not any(brute_quote(q, s[4]) is not None for c in cues for q in c.split('"')[1::2] for s in segments):
        errors.append(("transcript_match", "Audio cues not found in transcript"))
    outside = [t for t in stamps if not any(s[2] <= t <= s[3] for s in segments)]
    if cues and outside:
        errors.append(("timestamp_alignment", f"No audio segment found for timestamp {outside[0]}"))
    for t in stamps:
        where = "intro" if t < 10000 else "outro" if duration is not None and t > duration - 30000 else None
        if where:
            errors.append(("intro_outro", f"Timestamp in {where} region"))
            break
    if not m["visual_cues"]:
        errors.append(("dual_cue", "No visual cues specified"))
    elif not cues:
        errors.append(("dual_cue", "No audio cues specified"))
    elif not m["correspondence"]:
        errors.append(("dual_cue", "No correspondence explanation provided"))
    return errors


def test_moment_gate(spark):
    rng = random.Random(4)
    frames = {(v, f) for v in (1, 2) for f in range(0, 40, 2)}
    transcript = [(v, s, s * 9000, s * 9000 + 7000, rng.choice(["the door opens now", "she walks away slowly", "a bell rings"])) for v in (1, 2) for s in range(10)]
    durations = {1: 90000}
    rows = []
    for i in range(300):
        some = lambda pool, n: rng.choice([None, [], rng.choices(pool, k=n), rng.choices(pool, k=n), rng.choices(pool, k=n)])
        rows.append({
            "id": i, "video_id": rng.choice([1, 1, 1, 2, 3]), "frame_ids": some([0, 2, 4, 6, 8, 9], 2), "timestamps": some([5000, 12000, 20000, 47000, 53500, 80000], 2), "visual_cues": some(["a lamp"], 1),
            "audio_cues": some(['says "the door opens"', 'says "tha dour opens"', 'says "nothing like it"', "no quote"], 1), "correspondence": rng.choice(["x", "x", "", None]), "primary": rng.choice(["Temporal", "Counting", "odd"]), "secondary": rng.choice([None, [], ["counting"]]),
        })
    schema = "id long, video_id long, frame_ids array<bigint>, timestamps array<bigint>, visual_cues array<string>, audio_cues array<string>, correspondence string, primary string, secondary array<string>"
    judged = M.judged_moments(
        spark.createDataFrame([tuple(r.values()) for r in rows], schema), spark.createDataFrame(sorted(frames), "video_id long, frame_id long"), spark.createDataFrame(list(durations.items()), "video_id long, duration_ms long"),
        spark.createDataFrame(transcript, "video_id long, seq long, start_ms long, end_ms long, text string"), match_quotes=True, align=True,
    ).cache()
    want = {r["id"]: brute(r, frames, durations.get(r["video_id"]), transcript) for r in rows}
    assert {r["id"]: [tuple(e) for e in r["errors"]] for r in judged.collect()} == want and judged.count() == len(rows)
    assert {rule for e in want.values() for rule, _ in e} == set(M.RULES)
    # The outputs agree with each other.
    good, bad = {r["id"] for r in M.accepted(judged).collect()}, {r["id"] for r in M.rejected(judged).collect()}
    assert good == {i for i, e in want.items() if not e} and bad == set(want) - good
    for s in M.summary(judged).collect():
        own = [want[r["id"]] for r in rows if r["video_id"] == s["video_id"]]
        assert (s["total"], s["validated"], s["rejected"]) == (len(own), sum(not e for e in own), sum(bool(e) for e in own))
        assert [s[f"{r}_failed"] for r in M.RULES] == [sum(any(x[0] == r for x in e) for e in own) for r in M.RULES]
    aliases = {"Temporal": "Temporal Understanding", "counting": "Counting"}
    counts = Counter((r["video_id"], aliases.get(t, t)) for r in rows if not want[r["id"]] for t in [r["primary"], *(r["secondary"] or [])])
    for c in M.coverage(judged, {"Temporal Understanding": 2, "Counting": 1, "Needle": 1}, aliases).collect():
        assert c["n"] == counts[c["video_id"], c["type"]] and c["met"] == (c["n"] >= c["need"])
