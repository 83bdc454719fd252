import glob
import re
from collections import Counter

from tradelake.plans.jobs import run_word_count

# Fixed input: five paragraphs written without line breaks (one line).
LINES = [
    "In my younger and more vulnerable years my father gave me some advice that I've been "
    "turning over in my mind ever since. \"Whenever you feel like criticising any one,\""
    " he told me, \"just remember that all the people in this world haven't had the advantages"
    " that you've had.\"",
    "Most of the big shore places were closed now and there were hardly any lights except the "
    "shadowy, moving glow of a ferryboat across the Sound. And as the moon rose higher the "
    "inessential houses began to melt away until gradually I became aware of the old island "
    "here that flowered once for Dutch sailors' eyes--a fresh, green breast of the new world. "
    "Its vanished trees, the trees that had made way for Gatsby's house, had once pandered in "
    "whispers to the last and greatest of all human dreams; for a transitory enchanted moment "
    "man must have held his breath in the presence of this continent, compelled into an "
    "aesthetic contemplation he neither understood nor desired, face to face for the last time "
    "in history with something commensurate to his capacity for wonder.",
    "And as I sat there, brooding on the old unknown world, I thought of Gatsby's wonder when "
    "he first picked out the green light at the end of Daisy's dock. He had come a long way to "
    "this blue lawn and his dream must have seemed so close that he could hardly fail to grasp "
    "it. He did not know that it was already behind him, somewhere back in that vast obscurity "
    "beyond the city, where the dark fields of the republic rolled on under the night.",
    "Gatsby believed in the green light, the orgastic future that year by year recedes before "
    "us. It eluded us then, but that's no matter--tomorrow we will run faster, stretch out our "
    "arms farther.... And one fine morning----",
    "So we beat on, boats against the current, borne back ceaselessly into the past.      ",
]

# Golden samples of the expected output.
SAMPLES = {"a": 4, "and": 7, "gatsby": 1, "gatsby's": 2, "sailors'": 1, "that": 9, "the": 24}


def _run(spark, tmp_path):
    src = tmp_path / "input.txt"
    with open(src, "w") as fh:
        fh.writelines(LINES)
    out = str(tmp_path / "output")
    run_word_count(spark, str(src), out)
    return out


def test_word_count_golden(spark, tmp_path):
    out = _run(spark, tmp_path)
    actual = spark.read.csv(out, header=True, inferSchema=True)
    assert [(f.name, f.dataType.simpleString()) for f in actual.schema.fields] == [
        ("word", "string"), ("count", "int")]
    rows = [(r.word, r["count"]) for r in actual.collect()]
    assert len(rows) == 207
    assert [w for w, _ in rows] == sorted(w for w, _ in rows)
    got = dict(rows)
    for word, n in SAMPLES.items():
        assert got[word] == n
    brute = Counter(t for t in re.split(r"[^a-z']+", "".join(LINES).lower()) if t)
    assert got == dict(brute)


def test_word_count_quoted_parts(spark, tmp_path):
    out = _run(spark, tmp_path)
    parts = sorted(glob.glob(f"{out}/part-*.csv"))
    with open(parts[0]) as fh:
        lines = fh.read().splitlines()
    assert lines[0] == '"word","count"'
    assert lines[1] == '"a","4"'
