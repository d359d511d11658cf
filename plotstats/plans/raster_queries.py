"""Queries: reshaping all stored images."""

from __future__ import annotations

from plotstats.operators import raster
from plotstats.plans.views import IMAGE_SQL, images

SEED = 42
OUT = ["image_id", "row", "col", "val"]
_SHAPES = "(select distinct image_id, height, width, least(height, width) as a, greatest(height, width) as b from " + IMAGE_SQL + ")"
_START = {
    "topleft": "0",
    "center": "cast(floor(abs(height - width) / 2) as bigint)",
    "random": "case when height = width then 0 else cast('0x' || substr(md5(concat(image_id, '-42')), 1, 15) as bigint)"
    " % abs(height - width) end",
}


def _query(mode, size=None, position="topleft", padding="black"):
    def query(spark, sf_dir):
        return raster.reshape(images(spark, sf_dir), mode, ["val"], size, position, padding, SEED).select(*OUT)

    return query


def _target(position: str) -> str:
    """All cells of the square target, with t along the short axis, u along the long one and the start s."""
    return (
        f"(select *, {_START[position]} as s from {_SHAPES}, lateral (select unnest(range(b)) as t),"
        " lateral (select unnest(range(b)) as u))"
    )


def _fetch(position: str, source: str) -> str:
    """Reads index `source` along the short axis for every target cell."""
    return (
        "select g.image_id, case when height < width then t else u end as row, case when height < width then u else t end as col,"
        f" val from (select *, {source} as k from {_target(position)}) g join {IMAGE_SQL} p using (image_id, height, width)"
        " where p.row = case when height < width then k else u end and p.col = case when height < width then u else k end"
    )


_TILE = "case when t >= s then (t - s) % a else a - ((s - 1 - t) % a) - 1 end"


def _wave(k: str) -> str:
    return f"(case when {k} % (2 * (a - 1)) < a then {k} % (2 * (a - 1)) else 2 * (a - 1) - {k} % (2 * (a - 1)) end)"


_MIRROR = f"case when t >= s then {_wave('(t - s)')} else {_wave('(s - 1 - t)')} end"


def _resize(source: str, height: int, width: int) -> str:
    """Nearest pixel of a square or plain image table (image_id, row, col, val)."""
    return (
        f"select p.image_id, i as row, j as col, val from (select image_id, max(row) + 1 as h, max(col) + 1 as w from ({source})"
        f" group by image_id) d, lateral (select unnest(range({height})) as i), lateral (select unnest(range({width})) as j)"
        f" join ({source}) p on p.image_id = d.image_id and p.row = ((2 * i + 1) * h) // (2 * {height})"
        f" and p.col = ((2 * j + 1) * w) // (2 * {width})"
    )


_CROP = (
    "select image_id, case when height < width then row else row - s end as row, case when height < width then col - s else col end"
    f" as col, val from (select *, {_START['center']} as s, least(height, width) as a from {IMAGE_SQL})"
    " where case when height < width then col - s else row - s end between 0 and a - 1"
)


def _md5_number(text: str) -> str:
    return f"cast('0x' || substr(md5({text}), 1, 15) as bigint)"


def _contain(position: str, pad: str) -> str:
    row, col = "case when height < width then t else u end", "case when height < width then u else t end"
    grid = f"(select *, {row} as row, {col} as col from {_target(position)})"
    if pad == "clone":
        cell = "concat(g.image_id, '-', g.row, '-', g.col, '-{}-42')"
        choose = (
            f"case when t between s and s + a - 1 then case when g.height < g.width then t - s else u end else"
            f" {_md5_number(cell.format('r'))} % g.height end as pr,"
            f" case when t between s and s + a - 1 then case when g.height < g.width then u else t - s end else"
            f" {_md5_number(cell.format('c'))} % g.width end as pc"
        )
        return (
            f"select c.image_id, c.row, c.col, p.val from (select g.*, {choose} from {grid} g) c join {IMAGE_SQL} p"
            " on p.image_id = c.image_id and p.row = c.pr and p.col = c.pc"
        )
    return (
        f"select g.image_id, g.row, g.col, case when t between s and s + a - 1 then p.val else {pad} end as val from {grid} g"
        f" left join {IMAGE_SQL} p on p.image_id = g.image_id and p.row = case when g.height < g.width then t - s else u end"
        " and p.col = case when g.height < g.width then u else t - s end"
    )


_CELL_TEXT = "concat(g.image_id, '-', g.row, '-', g.col, '-val-42')"
_RANDOM_PAD = f"cast({_md5_number(_CELL_TEXT)} % 256 as double)"

QUERIES = {
    "raster_nearest": (_query("interp", (5, 7)), _resize(f"select * from {IMAGE_SQL}", 5, 7)),
    "raster_tile": (_query("tile", (12, 12), "center"), _resize(_fetch("center", _TILE), 12, 12)),
    "raster_mirror": (_query("mirror", None, "random"), _fetch("random", _MIRROR)),
    "raster_crop": (_query("crop", None, "center"), _CROP),
    "raster_contain": (_query("contain", None, "center", "white"), _contain("center", "255")),
    "raster_contain_random": (_query("contain", None, "random", "random"), _contain("random", _RANDOM_PAD)),
    "raster_contain_clone": (_query("contain", None, "center", "clone"), _contain("center", "clone")),
}
