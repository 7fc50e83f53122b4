"""DuckDB SQL fragments mirroring the Spark expressions (for oracles).

Patterns and delimiters are written here on their own, in RE2's spelling, so
that a fault in the engine's patterns shows as a difference.
"""

from __future__ import annotations

from maskweave.operators.vocab import CONTROL_IDS, SPECIAL_TOKENS

O, C = chr(9), chr(10)
MARK, CONT = chr(0x2581), "##"
SPACE = (r"\x09-\x0D\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WORD = (r"\p{L}\p{M}\p{Nd}\p{Nl}\p{Pc}\x{24B6}-\x{24E9}\x{1F130}-\x{1F149}\x{1F150}-\x{1F169}"
        r"\x{1F170}-\x{1F189}\x{200C}-\x{200D}")
WORDS = f"[{WORD}]+|[^{WORD}{SPACE}]+"
DIGITS = r"\p{N}|[^\p{N}]+"
# RE2 has no look-ahead: CUT is put before the last white space of a run that a
# word follows, which splits the run where the look-ahead would
CUT = chr(0x10FFFE)
BYTE_WORDS = (r"''s|''t|''re|''ve|''m|''ll|''d| ?\p{L}+| ?\p{N}+"
              rf"| ?[^\p{{L}}\p{{N}}{SPACE}{CUT}]+|[{SPACE}]+")


def sp_norm(x: str) -> str:
    # no text of the tables needs NFKC (normalize_edges has what does);
    # casefold differs from lower only by sharp s
    lowered = f"replace(lower({x}), '\u00df', 'ss')"
    return f"trim(regexp_replace({lowered}, '[{SPACE}]+', ' ', 'g'))"


def wp_word_list(x: str) -> str:
    return f"regexp_extract_all({x}, '{WORDS}')"


def byte_word_list(x: str) -> str:
    cut = f"regexp_replace({x}, '([{SPACE}])([{SPACE}][^{SPACE}])', '\\1{CUT}\\2', 'g')"
    return f"regexp_extract_all({cut}, '{BYTE_WORDS}')"


def wp_words(src: str = "documents", text: str = "text") -> str:
    return f"(select unnest({wp_word_list(text)}) as word from {src})"


def marked_words(src: str = "documents", text: str = "text", key: str = "doc_id") -> str:
    return f"""(select {key}, i, case when i = 1 then w else '{MARK}' || w end as word
  from (select {key}, unnest(l) as w, generate_subscripts(l, 1) as i
          from (select {key}, string_split({sp_norm(text)}, ' ') as l from {src}))
 where length(w) > 0)"""


def sp_pieces(src: str = "documents", text: str = "text") -> str:
    return f"""(select unnest(regexp_extract_all(word, '{DIGITS}')) as word
  from {marked_words(src, text)})"""


def byte_words(src: str = "documents", text: str = "text") -> str:
    return f"(select unnest({byte_word_list(text)}) as word from {src})"


def counts(words_sql: str) -> str:
    return f"(select word, count(*) as n from {words_sql} group by word)"


def symbol_sql(kind: str, w: str = "word") -> str:
    if kind == "wordpiece":
        s = f"regexp_replace({w}, '(.)', '{O}{CONT}\\1{C}', 'gs')"
        return f"regexp_replace({s}, '^{O}{CONT}', '{O}')"
    if kind == "bpe":
        return f"regexp_replace({w}, '(.)', '{O}\\1{C}', 'gs')"
    return f"regexp_replace(hex(encode({w})), '(..)', '{O}\\1{C}', 'g')"


def merged_sql(kind: str, l: str = "l", r: str = "r") -> str:
    if kind == "wordpiece":
        return f"{l} || case when starts_with({r}, '{CONT}') then substr({r}, 3) else {r} end"
    return f"{l} || {r}"


def symbols_sql(sy: str = "sy") -> str:
    return f"regexp_extract_all({sy}, '{O}([^{C}]*){C}', 1)"


def pairs_sql(w: str) -> str:
    return f"""(select l, r, cast(sum(n) as bigint) as n from (
    select n, a[i] as l, a[i + 1] as r from (
      select n, a, unnest(range(1, len(a))) as i from (select n, {symbols_sql()} as a from {w})))
  group by l, r)"""


def merge_rounds_sql(word_counts_sql: str, kind: str, rounds: int, min_pair_n: int = 2) -> str:
    """CTE text (without the final select) for ``rounds`` one-at-a-time
    merges; defines m1..mR (l, r, merged, n) and w0..wR."""
    parts = [f"w0 as materialized (select word, {symbol_sql(kind)} as sy, n from {word_counts_sql})"]
    for k in range(1, rounds + 1):
        parts.append(f"""m{k} as materialized (select l, r, {merged_sql(kind)} as merged, n
  from {pairs_sql(f'w{k - 1}')} where n >= {min_pair_n} order by n desc, l, r limit 1)""")
        parts.append(f"""w{k} as materialized (select coalesce(replace(w.sy, '{O}' || m.l || '{C}{O}' || m.r || '{C}',
  '{O}' || m.merged || '{C}'), w.sy) as sy, w.n as n, w.word from w{k - 1} as w left join m{k} as m on true)""")
    return "with " + ",\n".join(parts)


def merges_sql(word_counts_sql: str, kind: str, rounds: int) -> str:
    ctes = merge_rounds_sql(word_counts_sql, kind, rounds)
    union = "\nunion all ".join(
        f"select {k} as rank, l as \"left\", r as \"right\", merged, n from m{k}" for k in range(1, rounds + 1))
    return f"{ctes}\nselect * from ({union})"


def specials_sql(kind: str = "wordpiece") -> str:
    if kind == "bpe":
        rows = ", ".join(f"({i}, '{piece}', '{role}')" for role, i, piece in CONTROL_IDS)
    else:
        rows = ", ".join(f"({i}, '{tok}', '{role}')" for i, (role, tok) in enumerate(SPECIAL_TOKENS))
    return f"(select * from (values {rows}) as s(id, piece, role))"


def alphabet_sql(word_counts_sql: str, kind: str) -> str:
    """(piece, grp): characters, then continuation forms (as operators.merges.alphabet_pieces)."""
    chars = f"(select unnest(regexp_extract_all(word, '(?s).')) as c, generate_subscripts(regexp_extract_all(word, '(?s).'), 1) as i from {word_counts_sql})"
    bare = f"select distinct c as piece, 0 as grp from {chars}"
    if kind != "wordpiece":
        return f"({bare})"
    cont = f"select distinct '{CONT}' || c as piece, 1 as grp from {chars} where i > 1"
    return f"({bare} union all {cont})"


def base_vocab_sql(word_counts_sql: str, kind: str) -> str:
    """(id, piece, role): specials then the alphabet in (grp, piece) order."""
    if kind == "byte":
        alpha = "(select upper(lpad(hex(i), 2, '0')) as piece, 0 as grp from range(256) t(i))"
    else:
        alpha = alphabet_sql(word_counts_sql, kind)
    n_res = len(CONTROL_IDS) if kind == "bpe" else len(SPECIAL_TOKENS)
    return f"""(select id, piece, role from {specials_sql(kind)}
  union all
  select {n_res - 1} + row_number() over (order by grp, piece) as id, piece, null as role
    from {alpha} where piece not in (select piece from {specials_sql(kind)}))"""


def sp_doc_pieces(src: str = "documents", key: str = "doc_id") -> str:
    """(key, i, k, word): SentencePiece pieces per row in order."""
    return f"""(select {key}, i, unnest(regexp_extract_all(word, '{DIGITS}')) as word,
         generate_subscripts(regexp_extract_all(word, '{DIGITS}'), 1) as k
    from {marked_words(src, 'text', key)})"""


def byte_doc_words(src: str = "documents", key: str = "doc_id") -> str:
    lst = byte_word_list("text")
    return f"(select {key}, unnest({lst}) as word, generate_subscripts({lst}, 1) as i, 1 as k from {src})"


def vocab_with_merges_sql(counts_sql: str, kind: str, rounds: int, word_table: str | None = None) -> str:
    """CTE text: merge rounds, then base/learned/vocab (id, piece, role).  The
    rounds run over ``word_table``, the alphabet is that of ``counts_sql``."""
    ctes = merge_rounds_sql(word_table or counts_sql, kind, rounds)
    union = "\nunion all ".join(f"select {k} as rank, merged from m{k}" for k in range(1, rounds + 1))
    return f"""{ctes},
base as (select * from {base_vocab_sql(counts_sql, kind)}),
learned as (select merged as piece, min(rank) as rank from ({union})
             where merged not in (select piece from base) group by merged),
vocab as (select id, piece, role from base
          union all
          select (select max(id) from base) + row_number() over (order by rank) as id, piece, null as role
            from learned)"""


def bpe_encode_sql(counts_sql: str, doc_words_sql: str, kind: str, rounds: int, key: str = "doc_id") -> str:
    """Encode with merges applied in rank order: the last word table of the
    merge chain holds each word type's final symbols.  Words that the training
    rows do not have go through the chain too, with a count of 0."""
    syms = symbols_sql("sy")
    all_words = f"""(select word, max(n) as n from (
      select word, n from {counts_sql} union all select word, 0 from {doc_words_sql}) group by word)"""
    return f"""{vocab_with_merges_sql(counts_sql, kind, rounds, all_words)},
dw as {doc_words_sql},
wtok as (select word, unnest({syms}) as s, generate_subscripts({syms}, 1) as j from w{rounds}),
dtok as (select d.{key}, d.i, d.k, t.j, coalesce(v.id, 0) as id
           from dw d join wtok t on t.word = d.word left join vocab v on v.piece = t.s)
select s.{key}, cast(count(t.id) as bigint) as n_tokens,
       coalesce(string_agg(cast(t.id as varchar), ' ' order by t.i, t.k, t.j), '') as ids
  from documents s left join dtok t on t.{key} = s.{key} group by s.{key}"""
