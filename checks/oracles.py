"""The same results in SQL for DuckDB, written from the definitions."""

from __future__ import annotations

from corpusloom.functions.stop_words import ENGLISH
from corpusloom.operators.influence import WINDOWS

BOOKS = r"""
books as (
  select concat(cast(d.doc_id as varchar), '.txt') as file_name,
    concat(
      case when d.doc_id % 11 = 0 then '' else concat('Title: ', p.p_name, ' ', p.p_brand, chr(10)) end,
      case when d.doc_id % 13 = 0 then '' else concat('Author: ',
        case when d.doc_id % 5 = 0 then 'by ' else '' end, 'Writer ', cast(d.doc_id % 97 as varchar),
        case when d.doc_id % 7 = 0 then ' (1835-1910)' else '' end,
        case when d.doc_id % 3 = 0 then ',' else '' end, chr(10)) end,
      case when d.doc_id % 17 = 0 then '' else concat('Release Date: June 9, ',
        cast(1970 + (d.doc_id * 7) % 50 as varchar), ' [EBook #', cast(d.doc_id as varchar), ']', chr(10)) end,
      'Language: ', d.lang, chr(10), 'Character set encoding: UTF-8', chr(10),
      '*** START OF THIS EBOOK ***', chr(10), d.text, chr(10), '*** END OF THIS EBOOK ***', chr(10)) as text
  from documents d join part p on p.p_partkey = d.doc_id % 100)
"""

WORDS = r"""
words as (
  select w as word from (
    select unnest(string_split_regex(regexp_replace(text, '[^a-zA-Z0-9\s]', '', 'g'), '[ \t\n\r\f]+')) as w
    from documents)
  where w <> ''),
counts as (select word, count(*) as count from words group by word)
"""

METADATA = BOOKS + r""",
metadata as (
  select file_name,
    regexp_extract(text, 'Title:\s*(.+?)(?:\r?\n|$)', 1) as title,
    regexp_extract(text, 'Release Date:\s*(.+?)(?:\r?\n|$)', 1) as release_date,
    regexp_extract(text, 'Language:\s*(.+?)(?:\r?\n|$)', 1) as language,
    regexp_extract(text, 'Character set encoding:\s*(.+?)(?:\r?\n|$)', 1) as encoding
  from books),
dated as (
  select *, cast(regexp_extract(release_date, '([0-9]{4})', 1) as integer) as release_year
  from metadata where regexp_extract(release_date, '([0-9]{4})', 1) <> ''),
titles as (
  select title, cast(length(title) as integer) as title_length from metadata where title <> '')
"""

AUTHORS = BOOKS + r""",
found as (
  select file_name,
    trim(regexp_replace(regexp_replace(regexp_replace(
      trim(regexp_extract(text, 'Author:\s*(.+?)(?:\r?\n|$)', 1)),
      '^by\s+', '', 'i'), '\s*\([0-9]{4}[^)]*\)', '', 'g'), '[,\\.;]$', '')) as author_original,
    try_cast(regexp_extract(regexp_extract(text, 'Release Date:\s*(.+?)(?:\r?\n|$)', 1),
      '([0-9]{4})', 1) as bigint) as release_year
  from books),
authors as (
  select *, regexp_replace(regexp_replace(lower(author_original), '[^a-z0-9\s]', '', 'g'),
      '\s+', ' ', 'g') as author_norm
  from found where author_original <> '' and release_year <> 0)
"""


def _edges(window: int, name: str = "edges") -> str:
    return f"""
{name} as (
  select distinct a.author_original as author_from, b.author_original as author_to,
    a.release_year as year_from, b.release_year as year_to,
    b.release_year - a.release_year as year_diff
  from authors a join authors b
    on a.author_norm <> b.author_norm and a.release_year <= b.release_year - {window})
"""


CONTENT = BOOKS + r""",
marks as (
  select file_name, text,
    coalesce(nullif(strpos(text, '*** START OF'), 0), nullif(strpos(text, '***START OF'), 0),
      nullif(strpos(text, '*END*THE SMALL PRINT'), 0), 1) as s,
    coalesce(nullif(strpos(text, '*** END OF'), 0), nullif(strpos(text, '***END OF'), 0),
      nullif(strpos(text, 'End of Project Gutenberg'), 0), length(text) + 1) as e
  from books),
content as (select file_name, substring(text, s, greatest(e - s, 0)) as content from marks),
cleaned as (
  select file_name, regexp_replace(regexp_replace(lower(content), '[^a-zA-Z\s]', ' ', 'g'),
    '\s+', ' ', 'g') as clean_text
  from content)
"""

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in ENGLISH)

TOKENS = CONTENT + rf""",
tokens as (
  select file_name, t as term, i from (
    select file_name, unnest(string_split(clean_text, ' ')) as t,
      generate_subscripts(string_split(clean_text, ' '), 1) as i
    from cleaned)
  where length(t) >= 2 and t not in ({_STOP}))
"""

TF = TOKENS + """,
tf as (select file_name, term, count(*) as tf from tokens group by all)
"""

TARGET = """,
target as (
  select '200.txt' as wanted,
    coalesce(max(case when file_name = '200.txt' then file_name end), min(file_name)) as target
  from books)
"""

_WEIGHTS = """,
idf as (
  select term, count(*) as df,
    case when count(*) >= 2 then ln(((select count(*) from books) + 1.0) / (count(*) + 1.0))
      else 0.0 end as idf
  from {tf} group by term),
weights as (
  select file_name, term, t.tf * idf as weight from {tf} t join idf using (term) where idf > 0),
unit as (
  select file_name, term, weight / sqrt(sum(weight * weight) over (partition by file_name)) as weight
  from weights)
"""

_SCORES = """,
products as (
  select u.file_name, sum(u.weight * v.weight) as similarity
  from unit u join unit v on v.term = u.term and v.file_name = (select target from target)
  group by u.file_name),
scores as (
  select b.file_name, coalesce(p.similarity, 0.0) as similarity
  from books b left join products p using (file_name)
  where b.file_name <> (select target from target)),
top as (
  select cast(row_number() over (order by round(similarity, 10) desc, file_name) as integer) as rank, file_name, similarity
  from scores qualify rank <= 5)
"""

EXACT = TF + _WEIGHTS.format(tf="tf") + TARGET + _SCORES

# MurmurHash3 (32 bits, seed 42) of each term, its low 16 bits the bucket. Terms
# hold only a to z, so a character is a byte.
_TWO32 = "4294967296::ubigint"


def _byte(position: str) -> str:
    return f"cast(ascii(substr(term, cast({position} as bigint), 1)) as ubigint)"


BUCKETS = TF + rf""",
blocks as (
  select term, length(term) as n,
    list_transform(range(0, length(term) // 4), lambda i: {_byte('4*i+1')} + 256 * {_byte('4*i+2')}
      + 65536 * {_byte('4*i+3')} + 16777216 * {_byte('4*i+4')}) as words,
    case length(term) % 4
      when 0 then 0::ubigint
      when 1 then {_byte('length(term)')}
      when 2 then {_byte('length(term)-1')} + 256 * {_byte('length(term)')}
      else {_byte('length(term)-2')} + 256 * {_byte('length(term)-1')} + 65536 * {_byte('length(term)')}
    end as tail
  from (select distinct term from tf)),
scaled as (
  select term, n, list_transform(list_append(words, tail), lambda k: (k * 3432918353::ubigint) % {_TWO32}) as ks
  from blocks),
mixed as (
  select term, n, list_transform(ks, lambda k:
    (((k * 32768::ubigint) % {_TWO32} + k // 131072::ubigint) * 461845907::ubigint) % {_TWO32}) as ks
  from scaled),
folded as (
  select term, n, xor(ks[-1], list_reduce(ks[:-2], lambda h, k:
    (((xor(h, k) * 8192::ubigint) % {_TWO32} + xor(h, k) // 524288::ubigint) * 5::ubigint
      + 3864292196::ubigint) % {_TWO32}, 42::ubigint)) as h
  from mixed),
step1 as (select term, xor(h, n::ubigint) as h from folded),
step2 as (select term, (xor(h, h // 65536::ubigint) * 2246822507::ubigint) % {_TWO32} as h from step1),
step3 as (select term, (xor(h, h // 8192::ubigint) * 3266489909::ubigint) % {_TWO32} as h from step2),
buckets as (select term, xor(h, h // 65536::ubigint) % 65536::ubigint as bucket from step3),
bucket_tf as (
  select file_name, bucket as term, sum(tf) as tf from tf join buckets using (term) group by all)
"""

HASHED = BUCKETS + _WEIGHTS.format(tf="bucket_tf") + TARGET + _SCORES


_REPORT = """
select 1 as section, 0 as rank,
  'Top 5 books similar to ' || (select target from target) || ':' as line
union all select 1, 1, repeat('-', 50)
union all select 2, rank, rank || '. ' || file_name || ' - similarity: '
  || printf('%.6f', similarity) from top
union all select 3, i, l from (values (0, ''), (1, ''), (2, 'All similarity scores:'),
  (3, repeat('-', 50))) v(i, l)
union all select 4, 0, file_name || ': ' || printf('%.6f', similarity) from scores
"""


def _of_files(ctes: str) -> str:
    """The same over files: some are hidden and some have no bytes."""
    view = BOOKS.replace("books as (", "view as (", 1)
    files = """,
numbered as (select *, cast(replace(file_name, '.txt', '') as bigint) as n from view),
books as (
  select case n % 23 when 1 then '_' when 2 then '.' else '' end || file_name as file_name,
    case when n % 19 = 3 then '' else text end as text
  from numbered),
folders as (select n || '-folder.txt' as file_name from numbered where n % 29 = 7)
"""
    assert ctes.startswith(BOOKS)
    return view + files + ctes.removeprefix(BOOKS)


def all_oracles() -> dict[str, str]:
    sizes = "(values (cast(null as bigint)), (16777216), (268435456), (4194304)) s(split_bytes)"
    found = {
        "word_count": f"with {WORDS} select word, count from counts",
        "word_count_files": f"with {WORDS} select word, count from counts",
        "word_count_split_sizes": f"""with {WORDS}
            select split_bytes, (select count(*) from counts) as words,
              (select count(*) from words) as total from {sizes}""",
        "books_scan": f"with {BOOKS} select file_name, text from books",
        "word_count_positions": f"""with {WORDS}
            select word, count, row_number() over (order by word) as position from counts""",
        "books_per_year_positions": f"""with {METADATA}
            select release_year, count(*) as book_count,
              row_number() over (order by release_year desc) as position
            from dated group by release_year""",
        "books_per_language_positions": f"""with {METADATA}
            select language, count(*) as count,
              row_number() over (order by count(*) desc, language) as position
            from metadata where language <> '' group by language""",
        "degree_positions": f"""with {AUTHORS}, {_edges(5)}
            select 'out' as side, author_from as author,
              row_number() over (order by count(*) desc, author_from) as position
            from edges group by author_from
            union all select 'in', author_to, row_number() over (order by count(*) desc, author_to)
            from edges group by author_to""",
        "similar_positions": f"""with {HASHED}
            select file_name, round(similarity, 6) as similarity,
              row_number() over (order by round(similarity, 10) desc, file_name) as position
            from scores""",
        "file_outcomes": f"""with {_of_files(BOOKS)}
            select file_name, text, false as failed from books
            union all select file_name, null, true from folders""",
        "file_failures": f"with {_of_files(BOOKS)} select file_name from folders",
        "file_metadata": f"with {_of_files(METADATA)} select * from metadata",
        "file_term_frequency": f"with {_of_files(TF)} select file_name, term, tf from tf",
        "file_word_count": f"""with {_of_files(BOOKS)},
            {WORDS.replace('from documents', 'from books')} select word, count from counts""",
        "metadata": f"with {METADATA} select * from metadata",
        "metadata_csv": f"with {METADATA} select * from metadata",
        "metadata_sample": f"""with {METADATA} select {_cut('file_name')}, {_cut('title')},
            {_cut('release_date')}, {_cut('language')}, {_cut('encoding')}
            from metadata order by metadata.file_name limit 10""",
        "dated_books": f"with {METADATA} select * from dated",
        "books_per_year": f"""with {METADATA}
            select release_year, count(*) as book_count from dated group by release_year""",
        "books_per_language": f"""with {METADATA}
            select language, count(*) as count from metadata where language <> '' group by language""",
        "top_language": f"""with {METADATA}
            select language, count(*) as count from metadata where language <> '' group by language
            order by count(*) desc, language limit 1""",
        "titles": f"with {METADATA} select * from titles",
        "average_title_length": f"""with {METADATA}
            select round(avg(title_length), 6) as avg_length from titles""",
        "title_statistics": f"""with {METADATA}
            select 'count' as summary, cast(count(*) as varchar) as title,
              cast(count(*) as double) as title_length from titles
            union all select 'mean', cast(avg(try_cast(title as double)) as varchar),
              round(avg(title_length), 6) from titles
            union all select 'stddev', cast(stddev_samp(try_cast(title as double)) as varchar),
              round(stddev_samp(title_length), 6) from titles
            union all select 'min', min(title), min(title_length) from titles
            union all select 'max', max(title), max(title_length) from titles""",
        "row_counts": f"""with {METADATA}, {AUTHORS.removeprefix(BOOKS).lstrip(',')}, {_edges(5)}
            select 'books' as measure, count(*) as n from books
            union all select 'dated books', count(*) from dated
            union all select 'author books', count(*) from authors
            union all select 'vectors', count(*) from books
            union all select 'edges', count(*) from edges""",
        "authors": f"""with {AUTHORS}
            select file_name, author_original, release_year, author_norm from authors""",
        "author_variants": f"""with {AUTHORS}
            select author_norm, author_original, count(*) as copies,
              cast(sum(count(*)) over (partition by author_norm) as bigint) as book_count
            from authors group by author_norm, author_original""",
        "influence_edges_x5": f"with {AUTHORS}, {_edges(5)} select * from edges",
        "influence_edges_csv": f"with {AUTHORS}, {_edges(5)} select * from edges",
        "edges_of_author": f"""with {AUTHORS}, {_edges(5)} select * from edges
            where 'Writer 42' in (author_from, author_to)""",
        "edge_index_x5": f"""with {AUTHORS},
            nodes as (select distinct author_original, author_norm, release_year from authors)
            select row_number() over (order by release_year, author_original, author_norm) as position,
              author_original, author_norm, release_year,
              1 + (select count(*) from nodes b where b.release_year < a.release_year + 5) as partners_from,
              (select count(*) from nodes b where b.release_year >= a.release_year + 5
                and b.author_norm = a.author_norm) as own_partners,
              (select count(*) from nodes b where b.release_year >= a.release_year + 5
                and b.author_norm <> a.author_norm) as out_edges
            from nodes a""",
        "edges_from_index_x5": f"with {AUTHORS}, {_edges(5)} select * from edges",
        "edges_of_authors_x5": f"""with {AUTHORS}, {_edges(5)} select * from edges
            where author_from in ('Writer 7', 'Writer 42', 'nobody')""",
        "window_sweep": f"""with {AUTHORS}, {', '.join(_edges(x, f'e{x}') for x in WINDOWS)},
            sizes as ({' union all '.join(f'select {x} as window_years, count(*) as edges from e{x}' for x in WINDOWS)}),
            compared as (select window_years, edges, case when (select count(*) from e5) > 0
              then edges / (select count(*) from e5) else 0.0 end as ratio from sizes)
            select window_years, edges, round(ratio, 6) as ratio, printf('%.2fx', ratio) as change
            from compared""",
        "out_degree_authors_x5": f"""with {AUTHORS}, {_edges(5)}
            select author_from, count(distinct author_to) as out_degree from edges group by author_from""",
        "in_degree_authors_x5": f"""with {AUTHORS}, {_edges(5)}
            select author_to, count(distinct author_from) as in_degree from edges group by author_to""",
        "main_content": f"with {CONTENT} select * from content",
        "clean_text": f"with {CONTENT} select * from cleaned",
        "tokens": f"""with {CONTENT}
            select file_name, array_to_string(
              list_filter(string_split(clean_text, ' '), lambda t: length(t) >= 2), ' ') as tokens
            from cleaned""",
        "filtered_tokens": f"""with {TOKENS}
            select b.file_name, coalesce(string_agg(term, ' ' order by i), '') as tokens
            from books b left join tokens t using (file_name) group by b.file_name""",
        "term_frequency": f"with {TF} select * from tf",
        "term_idf": f"""with {TF} {_WEIGHTS.format(tf='tf')}
            select term, df, round(idf, 6) as idf from idf""",
        "tfidf_unit_weights": f"""with {TF} {_WEIGHTS.format(tf='tf')}
            select file_name, term, round(weight, 6) as weight from unit""",
        "similarity_target": f"with {BOOKS} {TARGET} select * from target",
        "hashed_unit_weights": f"""with {BUCKETS} {_WEIGHTS.format(tf='bucket_tf')}
            select file_name, cast(term as integer) as bucket, round(weight, 6) as weight from unit""",
        "similarity_report": f"with {HASHED} {_REPORT}",
        "similarity_report_files": f"with {EXACT} select line from ({_REPORT})",
        "degrees_csv": f"""with {AUTHORS}, {_edges(5)}
            select 'out' as side, author_from as author, count(*) as degree from edges group by author_from
            union all select 'in', author_to, count(*) from edges group by author_to""",
    }
    found["similar_indexed_top5"] = (
        f"with {EXACT} select rank, file_name, round(similarity, 6) as similarity from top"
    )
    for kind, cte in (("exact", EXACT), ("hashed", HASHED)):
        found[f"similar_{kind}_top5"] = (
            f"with {cte} select rank, file_name, round(similarity, 6) as similarity from top"
        )
        found[f"similar_{kind}_all"] = (
            f"with {cte} select file_name, round(similarity, 6) as similarity from scores"
        )
    for x in WINDOWS:
        for side, degree, top in (
            ("author_from", "out_degree", "top_influential"),
            ("author_to", "in_degree", "top_influenced"),
        ):
            counted = f"select {side}, count(*) as {degree} from edges group by {side}"
            found[f"{degree}_x{x}"] = f"with {AUTHORS}, {_edges(x)} {counted}"
            found[f"{top}_x{x}"] = f"""with {AUTHORS}, {_edges(x)}, d as ({counted})
                select cast(row_number() over (order by {degree} desc, {side}) as integer) as rank, {side},
                  case when length({side}) > 38 then substring({side}, 1, 38) || '..' else {side} end as label,
                  {degree}
                from d qualify rank <= 5"""
    return found


def _cut(column: str) -> str:
    return (
        f"case when length({column}) > 30 then substring({column}, 1, 27) || '...' "
        f"else {column} end as {column}"
    )
