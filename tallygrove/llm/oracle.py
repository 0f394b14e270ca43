"""DuckDB SQL of the corpus queries that SQL can express, by the plainest road.

Not here: entropy and model spans, hash-random order, page trees, discriminant
and character models, XXH64 fingerprints.  Those are tested against brute force.
"""

from __future__ import annotations

from tallygrove.llm.decontaminate import WINDOW as ITEM_WINDOW
from tallygrove.llm.line_dedup import MIN_WORDS
from tallygrove.llm.phrases import FIRST, LEAST, LONGEST, NO_LANGUAGE
from tallygrove.llm.quality_rules import MEASURES, POLICIES, RULES, STANDARD, WINDOW
from tallygrove.llm.shared import SPACE, WORD
from tallygrove.llm.vector_codes import ENTRIES, PARTS, ROUNDS, SCALE

ORACLE: dict[str, str] = {}

_AHEAD = f"(partition by doc_id order by st range between current row and {MIN_WORDS - 1} following)"
_BEHIND = f"(partition by doc_id order by en range between {MIN_WORDS - 1} preceding and current row)"

ORACLE["op1_line_dedup"] = f"""
with lines as (select doc_id, unnest(string_split(text, chr(10))) line,
    unnest(range(len(string_split(text, chr(10))))) k from documents),
counted as (select *, len(regexp_extract_all(line, '{WORD}')) n from lines),
placed as (select *, sum(n) over (partition by doc_id order by k) en,
    sum(n) over (partition by doc_id order by k) - n st from counted where n > 0),
runs as (
  select doc_id, k first_at, max(k) over {_AHEAD} last_at, st, max(en) over {_AHEAD} en,
    array_to_string(list(line) over {_AHEAD}, chr(10)) run from placed
  union
  select doc_id, min(k) over {_BEHIND}, k, min(st) over {_BEHIND}, en,
    array_to_string(list(line) over {_BEHIND}, chr(10)) from placed),
later as (select * from (select *, row_number() over (partition by run order by doc_id, first_at) nth
    from runs where en - st >= {MIN_WORDS}) x where nth > 1),
gone as (select distinct c.doc_id, c.k, c.n from counted c join later l
    on c.doc_id = l.doc_id and c.k between l.first_at and l.last_at),
cut as (select doc_id, count(*) n_lines, sum(n) n_words from gone group by doc_id),
rest as (select c.doc_id, string_agg(line, chr(10) order by c.k) text
    from counted c anti join gone g on c.doc_id = g.doc_id and c.k = g.k group by c.doc_id)
select d.doc_id, case when c.doc_id is null then d.text else coalesce(r.text, '') end text,
  cast(coalesce(n_lines, 0) as bigint) n_removed_lines,
  cast(coalesce(n_words, 0) as bigint) n_removed_words
from documents d left join cut c on d.doc_id = c.doc_id left join rest r on d.doc_id = r.doc_id"""


def _chars(pattern: str, text: str = "t") -> str:
    """How many characters of the text the pattern covers."""
    return f"(length({text}) - length(regexp_replace({text}, '{pattern}', '', 'g')))"


_LETTERS = r"regexp_replace(t, '\P{L}+', '', 'g')"
_LONE = rf"regexp_replace(' '||regexp_replace(t, '{SPACE}', '  ', 'g')||' ', ' [|#*$%&<>=~_-]+ ', chr(1), 'g')"
_BITS = " + ".join(f"case when {r.fails} then {1 << r.bit} else 0 end" for r in RULES)
_BASE = " or ".join(r.fails for r in RULES[:2])

ORACLE["op9_quality_rules"] = f"""
with texts as (select doc_id, coalesce(text, '') t, regexp_extract_all(coalesce(text, ''), '{WORD}') w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) l from documents),
grams as (select doc_id, i, array_to_string(w[i:i+{WINDOW - 1}], ' ') g
    from (select doc_id, w, unnest(range(1, greatest(len(w) - {WINDOW - 2}, 1))) i from texts) x),
twice as (select doc_id, unnest(range(i, i + {WINDOW})) p
    from (select doc_id, i, count(*) over (partition by doc_id, g) n from grams) x where n > 1),
covered as (select doc_id, count(distinct p) n from twice group by doc_id),
measured as (select x.doc_id, cast(len(w) as bigint) n_words,
    cast(length(regexp_replace(t, '{SPACE}', '', 'g')) as bigint) word_chars,
    cast({_chars("[#*$%&|<>]")} as bigint) n_symbols,
    cast(len(l) - len(list_distinct(l)) as bigint) n_dup_lines,
    cast(coalesce(c.n, 0) as bigint) n_repeat_words, cast(len(l) as bigint) n_lines,
    cast(length({_LETTERS}) as bigint) n_letters,
    cast({_chars(chr(92) + "p{Lu}", _LETTERS)} as bigint) n_upper,
    cast(length(regexp_replace({_LONE}, '[^'||chr(1)||']+', '', 'g')) as bigint) n_lone_marks
  from texts x left join covered c on x.doc_id = c.doc_id)
select doc_id, {", ".join(MEASURES)}, cast({_BITS} as bigint) failed_bits, ({_BASE}) base_failed,
  ({_BITS}) & {STANDARD.mask()} = 0 kept from measured"""

_ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _words(text: str) -> str:
    return f"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '{_ALNUM}')"


ORACLE["op10_decontaminate"] = f"""
with docs as (select doc_id, {_words("text")} w from documents),
items as (select cast(item_id as varchar) item, {_words("text")} w from benchmark),
item_windows as (select distinct item, m, array_to_string(w[i:i+m-1], ' ') g
    from (select item, w, m, unnest(range(1, len(w) - m + 2)) i
      from (select *, least({ITEM_WINDOW}, len(w)) m from items where len(w) > 0) x) y),
sizes as (select distinct m from item_windows),
doc_windows as (select doc_id, m, i, array_to_string(w[i:i+m-1], ' ') g
    from (select doc_id, w, m, unnest(range(1, len(w) - m + 2)) i from docs, sizes where len(w) >= m) x),
hits as (select doc_id, m, i, item from doc_windows join item_windows using (m, g)),
covered as (select doc_id, count(distinct p) n from (select doc_id, unnest(range(i, i + m)) p from hits) x group by doc_id),
named as (select doc_id, count(item) n, string_agg(item, ',' order by item) listed
    from (select distinct doc_id, item from hits) x group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, cast(coalesce(c.n, 0) as bigint) n_hit,
  cast(coalesce(n.n, 0) as bigint) n_items, sha256(coalesce(listed, '')) items_sha256,
  coalesce(c.n, 0) > 0 and 20 * coalesce(c.n, 0) >= len(w) contaminated
from docs d left join covered c on d.doc_id = c.doc_id left join named n on d.doc_id = n.doc_id"""


ORACLE["op11_phrases"] = f"""
with pieces as (select coalesce(lang, '{NO_LANGUAGE}') lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[.,;:!?\x0A-\x0D]')) piece from documents),
split as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') w from pieces),
sizes as (select lang, sum(len(w)) n from split group by lang),
grams as (select lang, w[i:i + k - 1] w from (select lang, w, k, unnest(range(1, len(w) - k + 2)) i
    from (select lang, w, unnest(range(1, {LONGEST} + 1)) k from split) x where len(w) >= k) y),
f as (select lang, w, count(*) f from grams group by lang, w),
candidates as (select * from f where len(w) >= 2 and f >= {LEAST}),
cuts as (select lang, w, f a, unnest(range(1, len(w))) k from candidates),
scored as (select c.*, h.f l, t.f r, n,
    (1000 * c.a::hugeint * n::hugeint) // (h.f::hugeint * t.f::hugeint) score
  from cuts c join f h on h.lang = c.lang and h.w = c.w[1:k] join f t on t.lang = c.lang and t.w = c.w[k+1:]
    join sizes s on s.lang = c.lang),
lowest as (select * from scored qualify row_number() over (partition by lang, w order by score, k) = 1),
inner_parts as (select distinct lang, f, unnest(list_distinct(flatten(list_transform(range(2, len(w)),
    lambda m: list_transform(range(1, len(w) - m + 2), lambda i: w[i:i+m-1]))))) w from candidates where len(w) > 2),
kept as (select * from lowest x where not exists (select 1 from inner_parts i
    where i.lang = x.lang and i.w = x.w and 100 * i.f >= 100 * x.a)),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, array_to_string(w, ' ')) rank from kept)
select lang, cast(rank as bigint) rank, array_to_string(w, ' ') phrase, cast(a as bigint) a, cast(l as bigint) l,
  cast(r as bigint) r, cast(n as bigint) n, cast(score as bigint) score from ranked where rank <= {FIRST}"""

_DISTANCE = "list_sum(list_transform(range(1, len(x.q) + 1), lambda i: (x.q[i] - b.q[i]) * (x.q[i] - b.q[i])))::bigint"
_LEAST_OF = "arg_min(b.e, {d}::hugeint * 1000 + b.e) e, min({d}) d".format(d=_DISTANCE)
_ROUND = """
a{k} as (select x.vec, x.p, any_value(x.q) q, {least} from parts x join b{k} b using (p) group by x.vec, x.p),
m{k} as (select p, e, i, sum(q[i]) s, count(*) n from (select p, e, q, unnest(range(1, len(q) + 1)) i from a{k}) x group by p, e, i),
g{k} as (select p, e, list(((s - ((s % n) + n) % n) // n)::bigint order by i) q from m{k} group by p, e),
b{next} as (select p, b.e, coalesce(g.q, b.q) q from b{k} b left join g{k} g using (p, e)),"""

ORACLE["op12_vector_codes"] = f"""
with kept as (select row_number() over (order by vec_id, embedding) vec, vec_id, label,
    list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) v from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select vec, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] q
    from (select vec, v, unnest(range({PARTS})) p from kept) x),
b0 as (select p, vec - 1 e, q from parts where vec <= {ENTRIES}),
{"".join(_ROUND.format(k=k, next=k + 1, least=_LEAST_OF) for k in range(ROUNDS))}
last as (select x.vec, x.p, {_LEAST_OF} from parts x join b{ROUNDS} b using (p) group by x.vec, x.p),
codes as (select vec, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) code, sum(d)::bigint error from last group by vec),
books as (select sha256(string_agg(array_to_string(q, ','), ',' order by p, e)) h from b{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256
from kept join codes using (vec), books"""

_KEPT = ", ".join(f"failed_bits & {p.mask()} = 0 kept_{p.name}_v{p.version}" for p in POLICIES)
ORACLE["op9_policies"] = (
    f"select doc_id, {', '.join(MEASURES)}, failed_bits, {_KEPT} from ({ORACLE['op9_quality_rules']}) ledger"
)


def _count(condition: str, name: str) -> str:
    return f"count(*) filter (where {condition}) {name}"


ORACLE["op9_ablations"] = f"with ledger as ({ORACLE['op9_quality_rules']})\n" + " union all ".join(
    f"select '{p.name}' \"policy\", cast({p.version} as int) \"version\", '{r.name}' \"rule\", "
    + _count(f"failed_bits & {1 << r.bit} <> 0", "n_failed") + ", "
    + _count(f"failed_bits & {p.mask()} = {1 << r.bit}", "n_only_this") + ", "
    + _count(f"failed_bits & {p.mask()} = 0", "n_kept") + ", "
    + _count(f"failed_bits & {p.mask() & ~(1 << r.bit)} = 0", "n_kept_without") + " from ledger"
    for p in POLICIES
    for r in RULES
    if r.name in p.rules
)
