"""Small tables with the odd cases that every operator has to stand."""

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, h1 int"


def documents(spark, texts, first=1):
    """Documents numbered from ``first``, with extra columns whose names operators use inside."""
    rows = [(i, t, "en", "s", None, "x", 0) for i, t in enumerate(texts, first)]
    return spark.createDataFrame(rows, DOCS)


def words(text):
    """Words as the contract has them: A-Z lowered, split at ASCII white space only."""
    import re

    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_list(text):
    w = words(text)
    if len(w) < 5:
        return [tuple(w)] if w else []
    return [tuple(w[i:i + 5]) for i in range(len(w) - 4)]


def smallest_reachable(nodes, links):
    """Component of every node: its smallest reachable member."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        x, y = root(a), root(b)
        parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}
