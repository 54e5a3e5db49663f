"""DuckDB SQL that gives the rows of the queries."""

REPEATS = r"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS seq
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM docs)
), firsts AS (
    SELECT seq, min(doc_id) AS first_id FROM windows GROUP BY seq
), gone AS (
    SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS place
    FROM windows JOIN firsts USING (seq) WHERE first_id < doc_id
), words AS (
    SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM docs
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS text, count(*) AS n_kept
    FROM words ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

NEAR = r"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), shingles AS MATERIALIZED (
    SELECT DISTINCT doc_id, array_to_string(words[i : i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 2))) AS i FROM docs WHERE len(words) > 0)
), sizes AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS MATERIALIZED (
    SELECT a, b FROM (
        SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
        FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
    ) JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
    WHERE 100 * common >= 80 * (p.n + q.n - common)
), reach AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) LEFT JOIN sizes USING (doc_id)
"""

RUNS = r"""
WITH parts AS MATERIALIZED (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(0, len(string_split(text, chr(10))))) AS number
    FROM documents WHERE text IS NOT NULL
), lines AS MATERIALIZED (
    SELECT *, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS words, row_number() OVER (PARTITION BY doc_id ORDER BY number) AS place
    FROM parts WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), followed AS MATERIALIZED (
    SELECT doc_id, place, line, words, lead(line) OVER w AS second, lead(words) OVER w AS more, lead(line, 2) OVER w AS third
    FROM lines WINDOW w AS (PARTITION BY doc_id ORDER BY place)
), runs AS MATERIALIZED (
    SELECT doc_id, place, 3 AS size, [line, second, third] AS seq FROM followed WHERE third IS NOT NULL
    UNION ALL SELECT doc_id, place, 2, [line, second] FROM followed WHERE second IS NOT NULL AND words + more >= 50
    UNION ALL SELECT doc_id, place, 1, [line] FROM followed WHERE words >= 50
), ordered AS (
    SELECT doc_id, place, size, row_number() OVER (PARTITION BY seq ORDER BY doc_id, place) AS nth FROM runs
), gone AS MATERIALIZED (
    SELECT DISTINCT lines.doc_id, lines.number FROM ordered JOIN lines
    ON lines.doc_id = ordered.doc_id AND lines.place BETWEEN ordered.place AND ordered.place + size - 1 WHERE nth > 1
), kept AS (
    SELECT doc_id, string_agg(line, chr(10) ORDER BY number) AS text FROM parts ANTI JOIN gone USING (doc_id, number) GROUP BY doc_id
)
SELECT doc_id, CAST(coalesce(len(string_split(documents.text, chr(10))), 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n, 0) AS BIGINT) AS n_deleted, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM documents LEFT JOIN kept USING (doc_id) LEFT JOIN (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id) USING (doc_id)
"""


def outliers() -> str:
    """The statistics in DuckDB's functions, then the estimate in the text both engines run."""
    from loadstone.llm import quality_rules as rules

    steps, estimate = [], "e0"
    for k in range(1, rules.STEPS + 1):
        steps.append(f"b{k} AS MATERIALIZED ({rules.BINS.format(rows='vectors', estimate=estimate)})")
        steps.append(f"e{k} AS MATERIALIZED ({rules.NEXT.format(bins=f'b{k}')})")
        estimate = f"e{k}"
    centre = rules.CENTRE.replace("{median}", "quantile_cont").replace("{rows}", "vectors")
    start = rules.START.replace("{median}", "quantile_cont").format(rows="vectors", centre="centre")
    vector = ", ".join(f"{text} AS x{i}" for i, text in rules.VECTOR.items())
    return rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, [words[i], words[i + 1], words[i + 2]] AS seq
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM docs)
), repeats AS (
    SELECT doc_id, count(DISTINCT place) AS n FROM (
        SELECT doc_id, unnest(range(i, i + 3)) AS place
        FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, seq) AS times FROM windows) WHERE times > 1
    ) GROUP BY doc_id
), stats AS MATERIALIZED (
    SELECT doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words, CAST(length(array_to_string(words, '')) AS BIGINT) AS word_chars,
        CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(repeats.n, 0) AS BIGINT) AS n_repeat_words
    FROM docs LEFT JOIN repeats USING (doc_id)
), judged AS MATERIALIZED (SELECT *, {rules.BASE_FAILED} AS base_failed FROM stats),
passed AS MATERIALIZED (SELECT *, {vector} FROM judged WHERE NOT base_failed),
groups AS MATERIALIZED ({rules.GROUPS.replace("{rows}", "passed")}),
vectors AS MATERIALIZED (SELECT p.*, grp FROM passed p JOIN groups USING (lang, source)),
enough AS (SELECT grp FROM vectors GROUP BY grp HAVING count(*) >= {rules.LEAST}),
centre AS MATERIALIZED (SELECT * FROM ({centre}) JOIN enough USING (grp)),
e0 AS MATERIALIZED ({start}),
{", ".join(steps)},
scored AS ({rules.VERDICT.format(rows="vectors", estimate=estimate, columns="doc_id")})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT base_failed AND coalesce(distance, 0) <= {rules.CUTOFF} AS kept
FROM judged LEFT JOIN scored USING (doc_id)
"""


def mixed() -> str:
    """Cells, raking and draw; the iteration is the text both engines run."""
    from loadstone.llm import mixing

    steps, cells = [], "c0"
    for number in range(mixing.ROUNDS):
        for margin in mixing.MARGINS:
            name = f"c{number}_{margin}"
            scale = mixing.SCALE.format(cells=cells, targets=f"t_{margin}", margin=margin, more="")
            steps.append(f"{name} AS MATERIALIZED ({scale})")
            cells = name
    targets = ", ".join(
        f"t_{m} AS MATERIALIZED ({mixing.TARGETS.format(cells='cells', margin=m, budget=mixing.BUDGET)})" for m in mixing.MARGINS
    )
    return rf"""
WITH texts AS MATERIALIZED (
    SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
    FROM documents
), firsts AS (
    SELECT doc_id, source, lang, len(words) AS tokens FROM texts
), counted AS (
    SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(words) AS word FROM texts)
    WHERE length(word) >= {mixing.TOPIC_LETTERS} GROUP BY doc_id, word
), best AS (
    SELECT doc_id, first(word ORDER BY -n, encode(word)) AS word FROM counted GROUP BY doc_id
), rows AS MATERIALIZED (
    SELECT doc_id, source, lang, CAST(tokens AS BIGINT) AS tokens,
        'topic' || (CAST('0x' || substr(md5(coalesce(word, '')), 1, 8) AS BIGINT) % {mixing.TOPICS}) AS topic
    FROM firsts LEFT JOIN best USING (doc_id)
), cells AS MATERIALIZED ({mixing.CELLS.format(rows="rows")}),
{targets},
c0 AS MATERIALIZED (SELECT *, have AS weight FROM cells),
{", ".join(steps)},
chances AS (SELECT source, lang, topic, CASE WHEN have > 0 THEN weight / have ELSE 1 END AS probability FROM {cells})
SELECT doc_id, tokens, topic, round(probability, 6) AS probability,
    CAST(CAST('0x' || substr(md5('{mixing.SEED}:' || doc_id), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 < probability AS sampled
FROM rows JOIN chances USING (source, lang, topic)
"""


def licences() -> str:
    """TF-IDF of every line and text against the templates, then the nearest licensed folder."""
    from loadstone.llm import licences as rules

    templates = ", ".join(
        "({}, '{}', '{}')".format(k, name, text.replace("'", "''")) for k, (name, text) in enumerate(rules.TEMPLATES)
    )
    fold = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
WITH docs AS MATERIALIZED (
    SELECT doc_id, regexp_replace(CAST(doc_id // 10 AS VARCHAR), '(.)', '\1/', 'g') AS folder_below, doc_id < 10 AS top,
        string_split({fold.format('text')}, chr(10)) AS lines
    FROM documents
), placed AS MATERIALIZED (
    SELECT doc_id, lines, CASE WHEN top THEN '' ELSE rtrim(folder_below, '/') END AS folder,
        CASE WHEN top THEN '' ELSE folder_below END || CASE WHEN doc_id % 10 = 0 THEN 'LICENSE' ELSE CAST(doc_id AS VARCHAR) END AS path FROM docs
), segments AS MATERIALIZED (
    SELECT doc_id, number, term, count(*) AS tf FROM (
        SELECT doc_id, number, unnest(regexp_extract_all(line, '[a-z0-9]+')) AS term
        FROM (SELECT doc_id, unnest(lines) AS line, unnest(range(0, len(lines))) AS number FROM placed)
    ) GROUP BY ALL
), wholes AS MATERIALIZED (
    SELECT doc_id, -1 AS number, term, sum(tf) AS tf FROM segments GROUP BY doc_id, term
), templates(k, name, body) AS (VALUES {templates}
), vocabulary AS MATERIALIZED (
    SELECT k, name, term, count(*) AS tf
    FROM (SELECT k, name, unnest(regexp_extract_all({fold.format('body')}, '[a-z0-9]+')) AS term FROM templates) GROUP BY ALL
), total AS (SELECT count(*) AS n FROM documents WHERE text IS NOT NULL
), idf AS MATERIALIZED (
    SELECT term, ln((any_value(total.n) + 1.0) / (count(DISTINCT wholes.doc_id) + 1)) + 1 AS idf
    FROM (SELECT DISTINCT term FROM vocabulary) LEFT JOIN wholes USING (term) CROSS JOIN total GROUP BY term
), weights AS MATERIALIZED (
    SELECT k, name, term, tf * idf AS w, sqrt(sum(power(tf * idf, 2)) OVER (PARTITION BY k)) AS norm FROM vocabulary JOIN idf USING (term)
), vectors AS MATERIALIZED (
    SELECT doc_id, number, term, tf * coalesce(idf, (SELECT ln(n + 1) + 1 FROM total)) AS w
    FROM (SELECT * FROM segments UNION ALL SELECT * FROM wholes) LEFT JOIN idf USING (term)
), norms AS MATERIALIZED (
    SELECT doc_id, number, sqrt(sum(w * w)) AS norm FROM vectors GROUP BY doc_id, number
), scores AS MATERIALIZED (
    SELECT doc_id, number, name, dot / (norms.norm * tnorm) AS score FROM (
        SELECT doc_id, number, k, name, sum(vectors.w * weights.w) AS dot, any_value(weights.norm) AS tnorm
        FROM vectors JOIN weights USING (term) GROUP BY doc_id, number, k, name
    ) JOIN norms USING (doc_id, number)
), notices AS MATERIALIZED (
    SELECT doc_id, arg_max(name, score) AS licence, max(score) AS score FROM scores
    WHERE number >= 0 GROUP BY doc_id HAVING max(score) >= {rules.NOTICE_SCORE}
), given AS MATERIALIZED (
    SELECT folder, first(licence ORDER BY round(score, 9) DESC, doc_id) AS licence, max(score) AS score FROM (
        SELECT doc_id, coalesce(files.licence, notices.licence) AS licence, coalesce(files.score, notices.score) AS score
        FROM (SELECT doc_id, arg_max(name, score) AS licence, max(score) AS score FROM scores
              WHERE number < 0 GROUP BY doc_id HAVING max(score) >= {rules.FILE_SCORE}) files
        FULL JOIN (SELECT * FROM notices WHERE doc_id % 10 = 0) notices USING (doc_id)
    ) JOIN placed USING (doc_id) GROUP BY folder
), nearest AS (
    SELECT doc_id, arg_max(given.licence, len(given.folder)) AS licence, arg_max(given.score, len(given.folder)) AS score,
        arg_max(given.folder, len(given.folder)) AS folder
    FROM placed JOIN given ON given.folder = '' OR placed.folder = given.folder OR starts_with(placed.folder, given.folder || '/') GROUP BY doc_id
)
SELECT doc_id, placed.path, coalesce(notices.licence, nearest.licence) AS licence,
    CASE WHEN notices.licence IS NOT NULL THEN 'notice' WHEN nearest.licence IS NOT NULL THEN 'inherited' END AS how,
    round(coalesce(notices.score, nearest.score), 6) AS score,
    CASE WHEN notices.licence IS NOT NULL THEN placed.path ELSE nearest.folder END AS source_path
FROM placed LEFT JOIN notices USING (doc_id) LEFT JOIN nearest USING (doc_id)
"""

# ``m`` and the scores are integers; only the weight of a term is rounded down from a double.
SEARCH = r"""
WITH words AS MATERIALIZED (
    SELECT doc_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM documents WHERE text IS NOT NULL
), lengths AS MATERIALIZED (
    SELECT doc_id, count(*) AS n FROM words GROUP BY doc_id
), totals AS MATERIALIZED (
    SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM lengths
), asked AS MATERIALIZED (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL
), held AS MATERIALIZED (
    SELECT doc_id, term, count(*) AS tf FROM words SEMI JOIN asked USING (term) GROUP BY doc_id, term
), weights AS MATERIALIZED (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
    FROM held, totals GROUP BY term, docs
), impacts AS MATERIALIZED (
    SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // terms))) AS part
    FROM held JOIN lengths USING (doc_id) JOIN weights USING (term), totals
), scores AS (
    SELECT item_id, doc_id, CAST(sum(part) AS BIGINT) AS score FROM asked JOIN impacts USING (term) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
    FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 50
"""


def repairs() -> str:
    """Faults and cheapest repair of conversations: a fold over the rows with the best (cost, audit, text) per state."""
    def edit(state: str, cost: str, initial: str, line: str | None = None) -> str:
        out = f"{state}.out" + (f" || chr(10) || {line}" if line else "")
        return f"{{'cost': {state}.cost + {cost}, 'audit': {state}.audit || '{initial}', 'out': {out}}}"

    def row(states: str, stay: str, role: str, end: str) -> str:
        """Best ways into a state by a row that stays: kept or given the role."""
        ways = []
        for state in states:
            kept = f"CASE WHEN r.initial = '{stay}' AND NOT r.gone THEN 0 ELSE 1000000000 END + r.extra"
            ways.append(edit(f"a.{state}", kept, "K", "r.role || ':' || r.text"))
            if role:
                ways.append(edit(f"a.{state}", "CASE WHEN r.gone THEN 1000000000 ELSE 1 END + r.extra", "R", f"'{role}:' || r.text"))
        return f"least({edit(f'a.{end}', '2', 'D')}, {', '.join(ways)})"

    def insertions(states: str) -> str:
        """Insertions after the best ways into n, s, u and a of ``states``."""
        user = f"least(t.u, {', '.join(edit(f't.{s}', '5', 'I', chr(39) + 'user:' + chr(39)) for s in 'nsa')})"
        return (
            f"list_transform([{states}], lambda t: {{'n': t.n, 's': t.s, 'u': {user}, 'a': t.a}})[1]"
        )

    def last(states: str) -> str:
        assistant = edit("t.u", "5", "I", "'assistant:'")
        return f"list_transform([{states}], lambda t: {{'n': t.n, 's': t.s, 'u': t.u, 'a': least(t.a, {assistant})}})[1]"

    never = "{'cost': 1000000000000::BIGINT, 'audit': '', 'out': ''}"
    start = f"{{'n': {{'cost': 0::BIGINT, 'audit': '', 'out': ''}}, 's': {never}, 'u': {never}, 'a': {never}}}"
    step = (
        f"{{'n': {edit('a.n', '2', 'D')}, 's': {row('n', 's', '', 's')}, 'u': {row('nsa', 'u', 'user', 'u')}, 'a': {row('u', 'a', 'assistant', 'a')}}}"
    )
    return rf"""
WITH coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(
        list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda c: CAST(ascii(c) AS BIGINT)),
        lambda c, b: list_reduce(range(8), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(c, b)), CAST(4294967295 AS BIGINT)
    ), 4294967295) % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded WHERE kind <> 0
), placed AS MATERIALIZED (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS number FROM damaged
), judged AS MATERIALIZED (
    SELECT *, left(role, 1) AS initial, NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS blank,
        row_number() OVER (PARTITION BY conv_id, role, text ORDER BY number) > 1 AS again,
        NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') AS cut,
        lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY number) || left(role, 1) AS pair
    FROM placed
), folded AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
        count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated,
        count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
        list_reduce(
            list({{'initial': initial, 'gone': blank OR again, 'extra': CASE WHEN cut THEN 5 ELSE 0 END, 'role': role, 'text': text}} ORDER BY number),
            lambda a, r: {last(insertions(step))}, {last(insertions(start))}
        ) AS best
    FROM judged GROUP BY conv_id
), chosen AS (
    SELECT *, least(best.n, best.a) AS way FROM folded
)
SELECT ids.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
    CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
    CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(way.cost, 0) AS BIGINT) AS cost,
    coalesce(way.audit, '') AS audit, sha256(coalesce(substr(way.out, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) ids LEFT JOIN chosen ON ids.conv_id IS NOT DISTINCT FROM chosen.conv_id
"""
