import random

from cadenza.llm import lines


def within_one(a, b):
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def brute(docs):
    firsts = {}
    for doc, text in sorted(docs):
        for no, line in lines.text_lines(text):
            firsts.setdefault(line, (doc, no))
    gone = {a for a in firsts for b in firsts if a != b and firsts[b] < firsts[a] and within_one(a, b)}
    return {doc: "\n".join(p for no, p in enumerate(text.split("\n")) if not any(
        no == n and (x in gone or firsts[x] != (doc, no)) for n, x in lines.text_lines(text))) for doc, text in docs}


def variant(rng, line):
    i, c = rng.randrange(len(line)), rng.choice("abx ")
    return rng.choice([line[:i] + line[i + 1:], line[:i] + c + line[i:], line[:i] + c + line[i + 1:]])


def test_against_brute_force(spark):
    rng = random.Random(4)
    pool = [" ".join(rng.choice(["aa", "b", "aaa", "ab", "été"]) for _ in range(rng.randint(5, 9))) for _ in range(40)]
    docs = []
    for doc in range(150):
        text = []
        for _ in range(rng.randint(0, 6)):
            line = rng.choice(pool)
            for _ in range(rng.choice([0, 0, 1, 2])):
                line = variant(rng, line)
            text.append(rng.choice(["", " ", "\t"]) + line)
        docs.append((doc, "\n".join(text)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert dict(lines.line_dedup(df).select("doc_id", "text").collect()) == brute(docs)


def test_clean_documents_and_short_lines_stay(spark):
    docs = [(1, "yes\nno\nfour short words here"), (2, "yes\nno\nfour short words here"), (3, "only this document has this line")]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert sorted(lines.line_dedup(df).select("doc_id", "text").collect()) == docs
