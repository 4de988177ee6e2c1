import bz2
import gzip
import random

import pytest

from quarrystone.sources import dumps

DUMP = r"""-- a dump; with 'quotes' in a comment
/*!40101 SET NAMES utf8 */;
CREATE TABLE IF NOT EXISTS `findings` (
  `id` int(11) NOT NULL DEFAULT '0', -- the id; of it
  `title` varchar(20) DEFAULT 'a,b;c',
  `score` decimal(5,2),
  PRIMARY KEY (`id`), KEY `k` (`title`,`id`)
) ENGINE=InnoDB;
INSERT INTO `findings` VALUES (1,'it''s; INSERT INTO x VALUES (1);',-1.50),(2,'back\\slash \'q\' \n"x"',NULL),
(3,"two ""d"" 'q' -- no comment",5--3
);
INSERT IGNORE INTO db.`findings` (`score`,`id`) VALUES (7.25,4), (nope,5) ON DUPLICATE KEY UPDATE id=id;
UPDATE findings SET title = 'INSERT INTO findings VALUES (9,9,9);';
REPLACE INTO public.other(a) VALUES (_binary 'äöü /* no */ --'),(concat('a', (1)));
insert into "findings" values (6,'',0);;
INSERT INTO `odd.name` VALUES ();
INSERT INTO findings SELECT * FROM x;
/* the ' end */"""
EXPECTED = [
    ("row", "findings", None, ["1", "it's; INSERT INTO x VALUES (1);", "-1.50"]),
    ("row", "findings", None, ["2", "back\\slash 'q' \n\"x\"", None]),
    ("row", "findings", None, ["3", "two \"d\" 'q' -- no comment", "5"]),
    ("row", "findings", ["score", "id"], ["7.25", "4"]),
    ("row", "findings", ["score", "id"], ["nope", "5"]),
    ("row", "findings", None, ["6", "", "0"]),
    ("row", "odd.name", None, []),
    ("row", "other", ["a"], ["concat('a',(1))"]),
    ("row", "other", ["a"], ["äöü /* no */ --"]),
    ("table", "findings", ["id", "title", "score"], ["int ( 11 ) NOT NULL DEFAULT '0'", "varchar ( 20 ) DEFAULT 'a,b;c'", "decimal ( 5 , 2 )"]),
]


def _read(rows):
    return sorted(((r.kind, r.table, r.columns, r["values"]) for r in rows.collect()), key=repr)


@pytest.mark.parametrize("split", [1, 7, 64, 1 << 20])
def test_rows_of_a_dump_cut_anywhere(spark, tmp_path, split):
    (tmp_path / "a.sql").write_text(DUMP)
    (tmp_path / "empty.sql").write_text("")
    (tmp_path / "no.txt").write_text(DUMP)
    assert _read(dumps.sql_dump(spark, str(tmp_path), split_bytes=split)) == sorted(EXPECTED, key=repr)


def test_every_cut_gives_one_state():
    """States chained over ranges cut at any byte are those of a plain scan over all that stands ahead."""
    for escapes in (True, False):
        lexer, data = dumps.Lexer(escapes), DUMP.encode()
        for size in (1, 2, 3, 11, 50):
            state, cuts = dumps.CODE, [0]
            for at in range(size, len(data), size):
                found = dumps._cut(data[at:])
                cuts.append(len(data) if found < 0 else at + found)
            for begin, stop in zip(cuts, [*cuts[1:], len(data)]):
                assert state == lexer.exit(data[:begin], dumps.CODE)
                state = [lexer.exit(data[begin:stop], s) for s in range(6)][state]


def test_random_dumps_against_what_was_written(spark, tmp_path):
    rng = random.Random(5)
    signs = ["'", '"', "`", "\\", "-", "--", "/*", "*/", ";", ",", "(", ")", "\n", "a", "é", " ", "INSERT INTO t VALUES (1);"]
    written, out = [], []
    for n in range(60):
        rows = [[str(n), *("".join(rng.choices(signs, k=rng.randrange(12))) for _ in range(3))] for _ in range(rng.randrange(1, 5))]
        written += rows
        quoted = ["(" + ",".join("'" + v.replace("\\", "\\\\").replace("'", rng.choice(["''", "\\'"])) + "'" for v in r) + ")" for r in rows]
        out.append(rng.choice(["", "-- it's\n", "/* `' */", "SET x = '\\'';"]) + "INSERT INTO t VALUES " + ",".join(quoted) + ";")
    (tmp_path / "r.sql").write_text("\n".join(out), newline="")
    for split in (13, 400):
        assert sorted(r["values"] for r in dumps.sql_dump(spark, str(tmp_path), split_bytes=split).collect()) == sorted(written)


def test_packed_dumps_and_typed_tables(spark, tmp_path):
    (tmp_path / "a.sql.gz").write_bytes(gzip.compress(DUMP.encode()))
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.sql.bz2").write_bytes(bz2.compress(b"INSERT INTO findings VALUES (8,'only','1.5');"))
    rows = dumps.sql_dump(spark, str(tmp_path), split_bytes=10)
    found = dumps.dump_table(rows, "findings", "id int, score double, title string, absent date").collect()
    assert sorted((r.id, r.score, r.title, r.absent) for r in found if r.id != 8) == [
        (1, -1.5, "it's; INSERT INTO x VALUES (1);", None), (2, None, "back\\slash 'q' \n\"x\"", None), (3, 5.0, "two \"d\" 'q' -- no comment", None),
        (4, 7.25, None, None), (5, None, None, None), (6, 0.0, "", None),
    ]
    # Without a CREATE TABLE columns go by the schema's order.
    assert [(r.id, r.score, r.title) for r in found if r.id == 8] == [(8, None, "1.5")]


def test_statements_written_are_read_as_they_were(spark, tmp_path):
    rows = [(1, "a'b\\'c\n;--/*", None, 1.5, True), (None, "", "x", None, None), (1, None, "`\"\r\n", -0.25, False)]
    frame = spark.createDataFrame(rows, "id long, `odd ``name` string, b string, c double, d boolean")
    dumps.dump_statements(frame, "t").write.text(str(tmp_path / "d"))
    back = dumps.dump_table(dumps.sql_dump(spark, str(tmp_path / "d"), names="^part-", split_bytes=9), "t", frame.schema)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, frame.collect()))


def test_standard_texts_know_no_backslash(spark, tmp_path):
    (tmp_path / "a.sql").write_text("INSERT INTO t VALUES ('a\\'),('b''c\\n');")
    assert sorted(r["values"] for r in dumps.sql_dump(spark, str(tmp_path), escapes=False, split_bytes=4).collect()) == [["a\\"], ["b'c\\n"]]


def test_an_unclosed_text_fails_with_its_place(spark, tmp_path):
    (tmp_path / "a.sql").write_text("INSERT INTO t VALUES (1);\nINSERT INTO t VALUES ('open")
    with pytest.raises(Exception, match="a.sql: byte .*isn't closed"):
        dumps.sql_dump(spark, str(tmp_path)).collect()
