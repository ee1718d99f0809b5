"""Checked readers: good rows, rejected lines as they stand, and counts."""

import pytest

from rankfold.sources import checked, readers


def got(c):
    rows, lines = [tuple(r) for r in c.rows.collect()], [r.line for r in c.rejected.collect()]
    assert (len(rows), len(lines)) == (c.n_rows, c.n_rejected)
    return sorted(rows, key=str), sorted(lines)


def file(tmp_path, text, name="f.txt"):
    p = tmp_path / name
    p.write_bytes(text.encode())
    return str(p)


@pytest.mark.parametrize("sep", ["\t", "::", ","])
def test_ratings(spark, tmp_path, sep):
    good = [(1, 2, 3.5, 4), (5, 6, 1.0, 7)]
    bad = [sep.join(x) for x in (["1", "2", "3"], ["1", "2", "3", "4", "5"], ["x", "2", "3", "4"], ["1", "2", "3.5.6", "4"], ["junk"])]
    path = file(tmp_path, "\n".join([sep.join(map(str, r)) for r in good] + bad) + "\n")
    assert got(checked.check_ratings(spark, path, sep)) == (good, sorted(bad))
    with pytest.raises(Exception, match="(?i)malformed"):
        readers.read_ratings(spark, path, sep).collect()


def test_items(spark, tmp_path):
    path = file(tmp_path, "1|Toy Story|x\n2\n\nx|Heat|y\n3|Up|a|b\n")
    assert got(checked.check_items(spark, path, "|")) == ([(1, "Toy Story"), (3, "Up")], ["2", "x|Heat|y"])
    path = file(tmp_path, "1::Toy Story::A|B\r\n2::Heat\r\nx::Up::C\r\n", "g.txt")
    assert got(checked.check_items(spark, path, "::")) == ([(1, "Toy Story", "A|B", "Toy Story <A|B>"), (2, "Heat", "", "Heat <>")], ["x::Up::C"])
    path = file(tmp_path, '1,"President, The (1995)",Comedy\n2,"Say ""Hi""",War\n3,Plain\nx,"A, B",C\n4,a,b,c\n', "h.txt")
    assert got(checked.check_items(spark, path, ",")) == ([(1, "President, The (1995)", "Comedy"), (2, 'Say "Hi"', "War")],
                                                         sorted(["3,Plain", 'x,"A, B",C', "4,a,b,c"]))


def test_other_formats(spark, tmp_path):
    path = file(tmp_path, "0,Will,33,385\r\n1,Jean,x,2\r\n2,Hugh,55\r\n")
    assert got(checked.check_people(spark, path)) == ([(0, "Will", 33, 385)], ["1,Jean,x,2", "2,Hugh,55"])
    path = file(tmp_path, "S1,18000101,TMAX,-75\nS2,18000101,TMIN,low\n", "r.txt")
    assert got(checked.check_readings(spark, path)) == ([("S1", "TMAX", -75.0)], ["S2,18000101,TMIN,low"])
    path = file(tmp_path, "44,8602,37.19\n35,5368\n", "s.txt")
    assert got(checked.check_spend(spark, path)) == ([(44, 37.19)], ["35,5368"])
    path = file(tmp_path, '1 "SPIDER-MAN"\n2 no quote\nx "BAD"\n', "n.txt")
    assert got(checked.check_node_names(spark, path)) == ([(1, "SPIDER-MAN")], ["2 no quote", 'x "BAD"'])
    path = file(tmp_path, "1 2 3 \n5\n\n1 x 4\nnode 7\n", "a.txt")
    assert got(checked.check_adjacency(spark, path)) == ([(1, [2, 3]), (5, [])], ["1 x 4", "node 7"])


def test_empty_file(spark, tmp_path):
    assert got(checked.check_ratings(spark, file(tmp_path, ""))) == ([], [])
    assert got(checked.check_node_names(spark, file(tmp_path, "\n\n", "b.txt"))) == ([], [])
