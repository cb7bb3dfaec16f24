"""DuckDB SQL for the recursive character splitter (oracle of ``chunk_text``).

Generated from the same parameters as ``quarry.operators.corpus`` (size, overlap,
separators), one block of CTEs per separator level:

* an item (article_id, key, txt, sidx) is cut before every occurrence of the first
  separator at or after ``sidx`` that occurs in it (the last separator if none does);
* consecutive pieces shorter than the size form runs (gaps and islands), merged by a
  ``list_reduce`` fold with the overlap rule;
* a longer piece becomes an item of the next level with the remaining separators, or
  is kept whole when none remain.

``key`` is the list of piece positions from the top, so ordering outputs by
(key, index) gives the chunk order.
"""

from __future__ import annotations

from quarry.operators.corpus import CHUNK_OVERLAP, CHUNK_SIZE, SEPARATORS

# Characters ``str.strip()`` removes (str.isspace), as a SQL string literal.
_WS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def _lit(s: str) -> str:
    """A DuckDB string literal for any text (control characters via chr())."""
    parts, plain = [], ""
    for ch in s:
        if ch == "'" or ord(ch) < 32 or ord(ch) > 126:
            if plain:
                parts.append("'" + plain + "'")
                plain = ""
            parts.append("'''" + "'" if ch == "'" else f"chr({ord(ch)})")
        else:
            plain += ch
    if plain:
        parts.append("'" + plain + "'")
    return "(" + " || ".join(parts) + ")" if parts else "''"


def _merge_expr(pieces: str, size: int, overlap: int) -> str:
    """Fold a list of pieces into chunks: append while the total fits; on overflow emit the
    stripped buffer, then drop leading pieces until the rest is at most ``overlap`` and
    leaves room for the next piece."""
    ws = _lit(_WS)
    # acc: ch = chunks so far, cur = buffered pieces, cum = running lengths of cur, tot = their sum
    init = "{'ch': []::VARCHAR[], 'cur': []::VARCHAR[], 'cum': []::BIGINT[], 'tot': CAST(0 AS BIGINT)}"
    # s(k): buffered total after dropping the first k pieces
    s_k = "(a.tot - CASE WHEN k = 0 THEN 0 ELSE a.cum[k] END)"
    first_k = (f"list_filter(range(0, len(a.cur) + 1), lambda k: {s_k} <= {overlap} "
               f"AND ({s_k} + length(x) <= {size} OR {s_k} = 0))[1]")
    after_pop = (f"list_transform([{first_k}], lambda k: {{'ch': b.ch, 'cur': a.cur[k + 1:], "
                 f"'cum': list_transform(a.cum[k + 1:], lambda c: c - CASE WHEN k = 0 THEN 0 ELSE a.cum[k] END), "
                 f"'tot': {s_k}}})[1]")
    emit = (f"list_transform([trim(array_to_string(a.cur, ''), {ws})], lambda j: "
            f"CASE WHEN j <> '' THEN list_append(a.ch, j) ELSE a.ch END)[1]")
    # bind the emitted chunk list as b.ch, then pop
    overflow = f"list_transform([{{'ch': {emit}}}], lambda b: {after_pop})[1]"
    popped = f"CASE WHEN a.tot + length(x) > {size} AND len(a.cur) > 0 THEN {overflow} ELSE a END"
    step = (f"list_transform([{popped}], lambda p: {{'ch': p.ch, 'cur': list_append(p.cur, x), "
            f"'cum': list_append(p.cum, p.tot + length(x)), 'tot': p.tot + length(x)}})[1]")
    folded = f"list_reduce({pieces}, lambda a, x: {step}, {init})"
    return (f"list_transform([{folded}], lambda r: list_transform([trim(array_to_string(r.cur, ''), {ws})], "
            f"lambda j: CASE WHEN j <> '' THEN list_append(r.ch, j) ELSE r.ch END)[1])[1]")


def chunk_sql(source: str, id_col: str, text_col: str, size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP,
              separators=tuple(SEPARATORS)) -> str:
    """CTE list (without WITH) ending in ``chunks(article_id, chunk_no, chunk)``."""
    seps = [_lit(s) for s in separators]
    last = len(seps) - 1
    first_sep = "CASE " + " ".join(f"WHEN sidx <= {i} AND contains(txt, {s}) THEN {i}" for i, s in enumerate(seps)) + " ELSE -1 END"
    sep_of = "CASE j " + " ".join(f"WHEN {i} THEN {s}" for i, s in enumerate(seps)) + f" ELSE {seps[last]} END"
    ctes = [f"items1 AS (SELECT {id_col} AS article_id, []::INTEGER[] AS key, {text_col} AS txt, 0 AS sidx "
            f"FROM {source} WHERE {text_col} IS NOT NULL)"]
    outs = []
    for lv in range(1, len(seps) + 1):
        ctes.append(f"""cut{lv} AS (
  SELECT article_id, key, CASE WHEN j >= 0 AND j < {last} THEN j + 1 END AS nxt,
         list_filter([parts[1]] || list_transform(parts[2:], lambda p: sep || p), lambda p: p <> '') AS pcs
    FROM (SELECT *, string_split(txt, sep) AS parts FROM (SELECT *, {sep_of} AS sep FROM (SELECT *, {first_sep} AS j FROM items{lv}))))""")
        ctes.append(f"""pcs{lv} AS (
  SELECT article_id, key, nxt, s.p AS piece, s.i AS pos, length(s.p) < {size} AS good
    FROM (SELECT article_id, key, nxt, unnest(list_transform(pcs, lambda p, i: {{'p': p, 'i': i}})) AS s FROM cut{lv}))""")
        ctes.append(f"""runs{lv} AS (
  SELECT article_id, key || [CAST(min(pos) AS INTEGER)] AS okey, {_merge_expr('list(piece ORDER BY pos)', size, overlap)} AS chunks
    FROM (SELECT *, pos - row_number() OVER (PARTITION BY article_id, key ORDER BY pos) AS grp FROM pcs{lv} WHERE good)
   GROUP BY article_id, key, grp)""")
        ctes.append(f"""whole{lv} AS (
  SELECT article_id, key || [CAST(pos AS INTEGER)] AS okey, [piece] AS chunks FROM pcs{lv} WHERE NOT good AND nxt IS NULL)""")
        outs += [f"SELECT * FROM runs{lv}", f"SELECT * FROM whole{lv}"]
        if lv < len(seps):
            ctes.append(f"""items{lv + 1} AS (
  SELECT article_id, key || [CAST(pos AS INTEGER)] AS key, piece AS txt, nxt AS sidx FROM pcs{lv} WHERE NOT good AND nxt IS NOT NULL)""")
    ctes.append("outs AS (" + "\n  UNION ALL ".join(outs) + ")")
    ctes.append("""chunks AS (
  SELECT article_id, CAST(row_number() OVER (PARTITION BY article_id ORDER BY okey, s.i) - 1 AS INTEGER) AS chunk_no, s.c AS chunk
    FROM (SELECT article_id, okey, unnest(list_transform(chunks, lambda c, i: {'c': c, 'i': i})) AS s FROM outs))""")
    return ",\n".join(ctes)


# ---- hashing encoder (oracle of embed_chunks) ------------------------------------------------

_M32 = 4294967296


def _bind(expr: str, name: str, body: str) -> str:
    """``body`` with ``name`` bound to ``expr`` (evaluated once)."""
    return f"list_transform([{expr}], lambda {name}: {body})[1]"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) << {r}) | (({x}) >> {32 - r})) & 4294967295"


def _mix_k(k: str) -> str:
    a = f"CAST((CAST({k} AS HUGEINT) * 3432918353) % {_M32} AS BIGINT)"
    return _bind(a, "ka", f"CAST((CAST({_rotl('ka', 15)} AS HUGEINT) * 461845907) % {_M32} AS BIGINT)")


def _mix_h(h: str, k: str) -> str:
    return _bind(f"xor({h}, {k})", "hx", f"(({_rotl('hx', 13)}) * 5 + 3864292196) % {_M32}")


def _fmix(h: str, n: str) -> str:
    s1 = _bind(f"xor({h}, {n})", "f1", "xor(f1, f1 >> 16)")
    s2 = _bind(s1, "f2", f"CAST((CAST(f2 AS HUGEINT) * 2246822507) % {_M32} AS BIGINT)")
    s3 = _bind(s2, "f3", "xor(f3, f3 >> 13)")
    s4 = _bind(s3, "f4", f"CAST((CAST(f4 AS HUGEINT) * 3266489909) % {_M32} AS BIGINT)")
    return _bind(s4, "f5", "xor(f5, f5 >> 16)")


def murmur3_sql(tok: str, seed: int = 42) -> str:
    """murmur3_x86_32 of an ASCII string (bytes = code points), unsigned, as SQL."""
    def byte(p: str) -> str:
        return f"CAST(ord(substring({tok}, {p}, 1)) AS BIGINT)"

    word = " | ".join(f"({byte(f'4 * i + {j + 1}')} << {8 * j})" for j in range(4))
    body = f"list_reduce(range(0, length({tok}) // 4), lambda h, i: {_mix_h('h', _mix_k(word))}, CAST({seed} AS BIGINT))"
    al = f"(length({tok}) // 4) * 4"
    tail = " | ".join(f"CASE WHEN length({tok}) % 4 > {j} THEN {byte(f'{al} + {j + 1}')} << {8 * j} ELSE 0 END"
                      for j in range(3))
    with_tail = _bind(body, "hb", f"CASE WHEN length({tok}) % 4 > 0 THEN xor(hb, {_mix_k(tail)}) ELSE hb END")
    return _fmix(with_tail, f"length({tok})")


def embed_sql(source: str, keys: list[str], text_col: str, dim: int) -> str:
    """CTE list (without WITH) ending in ``embedded(<keys>, embedding FLOAT[])``: lower-cased
    ``\\w+`` tokens, murmur3 (seed 42) of each, non-negative mod ``dim``, term counts, L2 norm."""
    k = ", ".join(keys)
    zeros = f"list_transform(range(0, {dim}), lambda i: CAST(0 AS FLOAT))"
    return f"""etok AS (
  SELECT {k}, unnest(regexp_extract_all(lower(coalesce({text_col}, '')), '\\w+')) AS t FROM {source}),
evocab AS (SELECT t, {murmur3_sql('t')} AS h FROM (SELECT DISTINCT t FROM etok)),
ebucket AS (SELECT t, CAST(((CASE WHEN h >= 2147483648 THEN h - {_M32} ELSE h END) % {dim} + {dim}) % {dim} AS INTEGER) AS b
  FROM evocab),
ecounts AS (SELECT {k}, b, count(*) AS c FROM etok JOIN ebucket USING (t) GROUP BY {k}, b),
evecs AS (SELECT {k}, map(list(b), list(c)) AS m, sqrt(sum(c * c)) AS norm FROM ecounts GROUP BY {k}),
embedded AS (
  SELECT {", ".join(f"s.{c}" for c in keys)},
         CASE WHEN v.norm IS NULL OR v.norm = 0 THEN {zeros}
              ELSE list_transform(range(0, {dim}), lambda i: CAST(coalesce(v.m[i], 0) / v.norm AS FLOAT)) END AS embedding
    FROM {source} s LEFT JOIN evecs v ON {" AND ".join(f"s.{c} = v.{c}" for c in keys)})"""
