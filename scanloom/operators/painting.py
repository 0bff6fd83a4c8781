"""Frames with their detections drawn in: boxes, masks, labels, a head line and a border."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from scanloom.sources import decode

# --- fixed values: widths, shares and colours of drawings, blue, green, red ------------
BOX_WIDTH, BORDER_WIDTH = 3, 5
#: Tenths: of a class colour in the overlay for each mask, and of picture and overlay in the result.
MASK_TENTHS, PICTURE_TENTHS, OVERLAY_TENTHS = 4, 7, 3
CAMERA_COLOURS = {"person": (0, 255, 0), "bicycle": (0, 255, 255), "car": (255, 0, 0), "motorcycle": (255, 0, 255), "bus": (0, 165, 255), "truck": (128, 0, 128)}
OTHER_COLOUR = (0, 255, 0)
BORDER_MASKED, BORDER_PLAIN = (0, 255, 255), (0, 255, 0)
# ----------------------------------------------------------------------------------------

#: Letters of three by five pixels, a row an octal digit from the top; what isn't here is blank.
LETTERS = {
    "0": 0o75557, "1": 0o26227, "2": 0o71747, "3": 0o71717, "4": 0o55711, "5": 0o74717, "6": 0o74757, "7": 0o71111, "8": 0o75757, "9": 0o75717,
    "A": 0o25755, "B": 0o65656, "C": 0o34443, "D": 0o65556, "E": 0o74647, "F": 0o74644, "G": 0o34553, "H": 0o55755, "I": 0o72227, "J": 0o11152,
    "K": 0o55655, "L": 0o44447, "M": 0o57755, "N": 0o65555, "O": 0o25552, "P": 0o65644, "Q": 0o25563, "R": 0o65655, "S": 0o34216, "T": 0o72222,
    "U": 0o55557, "V": 0o55552, "W": 0o55775, "X": 0o55255, "Y": 0o55222, "Z": 0o71247, ":": 0o02020, ".": 0o00002, "|": 0o22222, "-": 0o00700, "_": 0o00007,
}


def _rgb(colour: tuple[int, int, int]) -> np.ndarray:
    return np.array(colour[::-1], np.uint8)


def fill(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: np.ndarray) -> None:
    """Columns x1 to x2 and rows y1 to y2, ends included, as far as they lie in the image."""
    image[max(0, y1) : max(0, y2 + 1), max(0, x1) : max(0, x2 + 1)] = colour


def outline(image: np.ndarray, x1: int, y1: int, x2: int, y2: int, colour: np.ndarray, width: int) -> None:
    """The edges of a box, ``width`` (odd) pixels wide around its outermost pixels, with square corners."""
    h = width // 2
    for y in (y1, y2):
        fill(image, x1 - h, y - h, x2 + h, y + h, colour)
    for x in (x1, x2):
        fill(image, x - h, y1 - h, x + h, y2 + h, colour)


def letters(text: str, scale: int) -> np.ndarray:
    """A line of text as a mask, five rows of letters three wide and one apart, each pixel ``scale`` by ``scale``."""
    codes = np.array([LETTERS.get(c, 0) for c in text.upper()], np.int64)
    bits = codes[:, None, None] >> (14 - np.arange(15).reshape(5, 3)) & 1
    wide = np.pad(bits, ((0, 0), (0, 0), (0, 1))).transpose(1, 0, 2).reshape(5, -1)
    return np.kron(wide, np.ones((scale, scale), np.int64)).astype(bool)


def write(image: np.ndarray, x: int, y: int, text: str, colour: np.ndarray, scale: int) -> None:
    """Text with its lower left corner at (x, y), as far as it lies in the image."""
    mask = letters(text, scale)
    rows, cols = np.nonzero(mask)
    rows, cols = rows + y - mask.shape[0] + 1, cols + x
    inside = (rows >= 0) & (rows < image.shape[0]) & (cols >= 0) & (cols < image.shape[1])
    image[rows[inside], cols[inside]] = colour


def _corners(box) -> tuple[int, int, int, int] | None:
    """Whole pixels of a box, cut toward zero and put in order; none if it is no box."""
    if box is None or len(box) != 4 or any(v is None or not np.isfinite(v) for v in box):
        return None
    x1, y1, x2, y2 = (int(max(-1e6, min(1e6, v))) for v in box)
    return min(x1, x2), min(y1, y2), max(x1, x2), max(y1, y2)


def paint(pixels: np.ndarray, detections: list[dict], head: str | None, masked: bool, texts: bool) -> np.ndarray:
    """One frame with its detections in order; RGB."""
    image = np.repeat(pixels[:, :, :1], 3, axis=2) if pixels.shape[2] < 3 else pixels[:, :, :3].copy()
    overlay = np.zeros(image.shape, np.uint16)
    for det in detections:
        colour = _rgb(CAMERA_COLOURS.get(det["class_name"], OTHER_COLOUR))
        box = _corners(det["bbox"])
        if box:
            outline(image, *box, colour, BOX_WIDTH)
        if masked and det["runs"] is not None:
            mask = np.zeros(image.shape[:2], bool)
            for run in det["runs"]:
                if 0 <= run["r"] < len(mask):
                    mask[run["r"], max(0, run["first"]) : max(0, run["end"])] = True
            overlay[mask] = np.minimum(overlay[mask] + (MASK_TENTHS * colour.astype(np.uint16) + 5) // 10, 255)
        if texts and box and det["label"]:
            high, wide = letters(det["label"], 3).shape
            fill(image, box[0], box[1] - high - 10, box[0] + wide + 10, box[1], colour)
            write(image, box[0] + 5, box[1] - 5, det["label"], _rgb((255, 255, 255)), 3)
    if masked:
        image = ((PICTURE_TENTHS * image.astype(np.uint16) + OVERLAY_TENTHS * overlay + 5) // 10).astype(np.uint8)
    if texts and head:
        for shift, colour in ((1, (255, 255, 255)), (0, (0, 0, 0))):
            write(image, 10 + shift, 30 + shift, head, _rgb(colour), 3)
    if detections:
        outline(image, 0, 0, image.shape[1] - 1, image.shape[0] - 1, _rgb(BORDER_MASKED if masked else BORDER_PLAIN), BORDER_WIDTH)
    return image


def annotated_pictures(frames: DataFrame, detections: DataFrame, masked: bool = True, texts: bool = True) -> DataFrame:
    """Each picture with the detections of its frame and camera drawn in, as PNG.

    ``frames`` has (frame_id, camera, file), a file being a PNG or a sequential
    JPEG; ``detections`` has (frame_id, camera, det_idx, class_name, bbox, label,
    runs): a mask is an array of runs (r, first, end), null where there is none.
    Gives frame_id, camera, detections, masks, height, width, content and error.

    Detections are drawn in the order of ``det_idx``, later ones on top. With
    ``masked`` an overlay takes four tenths of the class colour for each mask, up to
    255, and the result is seven tenths of the picture and three of the overlay,
    rounded half up. Text is in plain letters of fifteen pixels. One frame is one
    task's row: its detections and their runs come to it by a shuffle, and nothing
    else does.

    Defined cases: a frame without detections has no border; a file that doesn't
    decode, or is null, gives a row with ``error``; each repeated frame is drawn; null
    or unfinished boxes are counted and not drawn; detections without a frame, and rows
    whose frame_id or camera is null, are left out (frames with null keys are drawn bare).
    """
    keys = ["frame_id", "camera"]

    def drawn(key: tuple, pictures: pa.Table, found: pa.Table) -> pa.Table:
        rows = sorted(found.to_pylist(), key=lambda d: (d["det_idx"] is None, d["det_idx"]))
        masks = sum(d["runs"] is not None for d in rows)
        parts = [f"FRAME: {key[0].as_py()}", str(key[1].as_py()).upper(), f"DETECTIONS: {len(rows)}"] + ([f"MASKS: {masks}"] if masked else [])
        out = []
        for file in pictures.column("file").to_pylist():
            row = {"frame_id": key[0].as_py(), "camera": key[1].as_py(), "detections": len(rows), "masks": masks}
            try:
                if file is None:
                    raise ValueError("no picture")
                image = paint(decode.picture(file), rows, " | ".join(parts), masked, texts)
                out.append(row | {"height": image.shape[0], "width": image.shape[1], "content": decode.png(image)})
            except Exception as e:  # a broken picture is a row
                out.append(row | {"error": f"{type(e).__name__}: {e}"})
        return pa.Table.from_pylist(out, schema=arrow)

    kinds = {"frame_id": pa.int64(), "camera": pa.string(), "detections": pa.int32(), "masks": pa.int32(), "height": pa.int32(), "width": pa.int32(), "content": pa.binary(), "error": pa.string()}
    arrow = pa.schema(list(kinds.items()))
    pictures = frames.select(F.col("frame_id").cast("long"), "camera", "file")
    run = "array<struct<r: long, first: long, end: long>>"
    known = detections.filter("frame_id IS NOT NULL AND camera IS NOT NULL")
    found = known.select(F.col("frame_id").cast("long"), "camera", F.col("det_idx").cast("long"), "class_name", F.col("bbox").cast("array<double>"), "label", F.col("runs").cast(run))
    schema = "frame_id long, camera string, detections int, masks int, height int, width int, content binary, error string"
    return pictures.groupBy(*keys).cogroup(found.groupBy(*keys)).applyInArrow(drawn, schema)


def mask_pictures(detections: DataFrame, height: int, width: int) -> DataFrame:
    """Each mask of (frame_id, camera, instance, class_name, confidence, runs) as a PNG of 0 and 255: (path, bytes).

    Masks are a row each, so that a frame with many is many tasks' work.
    """

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            files = []
            for runs in batch.column("runs").to_pylist():
                image = np.zeros((height, width), np.uint8)
                for run in runs:
                    if 0 <= run["r"] < height:
                        image[run["r"], max(0, run["first"]) : max(0, run["end"])] = 255
                files.append(decode.png(image))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(files, pa.binary())], names=["path", "bytes"])

    path = F.format_string("segmentation_masks/%s/%019d_%02d_%s_%.2f.png", F.col("camera"), F.col("frame_id").cast("long"), F.col("instance").cast("long"), F.col("class_name"), F.col("confidence").cast("double"))
    return detections.filter("runs IS NOT NULL").select(path.alias("path"), "runs").mapInArrow(each, "path string, bytes binary")
