"""Drawn frames: boxes, masks, text and borders by plain rules, and odd rows."""

import numpy as np
import pytest

from scanloom.operators import painting
from scanloom.sources import decode

GREEN, WHITE = (0, 255, 0), (255, 255, 255)
FRAME = "frame_id long, camera string, file binary"
FOUND = "frame_id long, camera string, det_idx long, class_name string, bbox array<double>, label string, runs array<struct<r: long, first: long, end: long>>, extra string"


def picture(h=20, w=30, colour=(10, 20, 30)):
    return decode.png(np.broadcast_to(np.array(colour, np.uint8), (h, w, 3)))


def slow(h, w, colour, found, masked):
    """Pixel by pixel: the last box that has it, then the blend of its masks, then the border."""
    out = np.zeros((h, w, 3), int)
    for y in range(h):
        for x in range(w):
            c, o = colour, (0, 0, 0)
            for name, (x1, y1, x2, y2), runs in found:
                own = painting.CAMERA_COLOURS.get(name, painting.OTHER_COLOUR)[::-1]
                if x1 - 1 <= x <= x2 + 1 and y1 - 1 <= y <= y2 + 1 and (min(abs(x - x1), abs(x - x2)) <= 1 or min(abs(y - y1), abs(y - y2)) <= 1):
                    c = own
                if runs and any(r == y and a <= x < b for r, a, b in runs):
                    o = tuple(min(255, p + int(0.4 * q + 0.5)) for p, q in zip(o, own))
            if masked:
                c = tuple((7 * p + 3 * q + 5) // 10 for p, q in zip(c, o))
            if found and min(x, y, w - 1 - x, h - 1 - y) <= 2:
                c = (255, 255, 0) if masked else GREEN
            out[y, x] = c
    return out


@pytest.mark.parametrize("masked", [True, False])
def test_pixels_of_frames(spark, masked):
    rng = np.random.default_rng(5)
    frames, rows, want = [], [], {}
    for f in range(12):
        found = []
        for k in range(f % 5):
            x, y, s, t = (int(v) for v in rng.integers(-4, 24, 4))
            box = (x, y, x + abs(s), y + abs(t))
            runs = [(int(r), int(a), int(a + n)) for r, a, n in zip(rng.integers(-2, 22, 9), rng.integers(-3, 30, 9), rng.integers(0, 12, 9))] if k % 2 else None
            found.append((["car", "person", "truck", "tree"][(f + k) % 4], box, runs))
            rows.append((f, "camera1", k, found[-1][0], [float(v) for v in box], None, runs, "x"))
        frames.append((f, "camera1", picture(colour=(f * 20, 255 - f, 7))))
        want[f] = slow(20, 30, (f * 20, 255 - f, 7), found, masked)
    got = painting.annotated_pictures(spark.createDataFrame(frames, FRAME), spark.createDataFrame(rows[::-1], FOUND), masked, texts=False).collect()
    assert len(got) == 12 and all(r.error is None and (r.height, r.width) == (20, 30) for r in got)
    for r in got:
        assert np.array_equal(decode.picture(bytes(r.content)), want[r.frame_id]), r.frame_id
        assert r.detections == r.frame_id % 5 and r.masks == (r.frame_id % 5) // 2


def test_odd_frames(spark):
    nan = float("nan")
    frames = [(1, "a", picture()), (1, "a", picture()), (2, "a", b"no picture"), (3, "a", None), (4, "b", picture()), (None, "a", picture()), (5, None, picture())]
    rows = [
        (1, "a", None, None, None, None, None, ""), (1, "a", 0, "car", [nan, 0.0, 1.0, 1.0], "x", None, ""), (1, "a", 1, "car", [25.0, 15.0, 5.0, 3.0], "car: 0.50", [], ""),
        (9, "a", 0, "car", [0.0, 0.0, 9.0, 9.0], "lost", None, ""), (None, "a", 0, "car", [0.0, 0.0, 9.0, 9.0], None, None, ""), (4, "b", 0, "bus", [-1e12, 2.0, 1e12, 1e300], "é", None, ""),
    ]
    f, d = spark.createDataFrame(frames, FRAME), spark.createDataFrame(rows, FOUND)
    got = painting.annotated_pictures(f, d).collect()
    assert sorted((r.frame_id or 0, r.camera or "", r.detections, r.masks, r.error is None) for r in got) == [
        (0, "a", 0, 0, True), (1, "a", 3, 1, True), (1, "a", 3, 1, True), (2, "a", 0, 0, False), (3, "a", 0, 0, False), (4, "b", 1, 0, True), (5, "", 0, 0, True),
    ]
    assert painting.annotated_pictures(f.limit(0), d).count() == 0 and painting.annotated_pictures(f, d.limit(0)).filter("detections > 0").count() == 0


def test_text():
    assert painting.letters("1:", 1).astype(int).tolist() == [[0, 1, 0, 0, 0, 0, 0, 0], [1, 1, 0, 0, 0, 1, 0, 0], [0, 1, 0, 0, 0, 0, 0, 0], [0, 1, 0, 0, 0, 1, 0, 0], [1, 1, 1, 0, 0, 0, 0, 0]]
    image = np.zeros((40, 60, 3), np.uint8)
    painting.write(image, -5, 30, "A 7?", np.array(WHITE, np.uint8), 3)
    whole = np.zeros((40, 80, 3), np.uint8)
    painting.write(whole, 10, 30, "a 7?", np.array(WHITE, np.uint8), 3)
    assert np.array_equal(image[:, :45], whole[:, 15:60]) and image[16:31].any() and not image[:16].any() and not image[31:].any()
    det = {"class_name": "car", "bbox": [20.0, 40.0, 50.0, 60.0], "label": "car: 0.50", "runs": None}
    drawn = painting.paint(np.zeros((80, 200, 3), np.uint8), [det], None, False, True)
    back = drawn[15:41, 20 : 20 + 9 * 12 + 11].reshape(-1, 3)
    letters = int(painting.letters("car: 0.50", 3).sum())
    assert (back == 255).all(axis=1).sum() == letters and (back == (0, 0, 255)).all(axis=1).sum() == len(back) - letters


def test_mask_files(spark):
    rows = [(7, "camera1", 0, "car", 0.5, [(1, 2, 5), (9, 0, 3), (-1, 0, 4), (3, -2, 2)]), (7, "camera1", 1, "dog", 0.25, []), (8, "camera2", 0, "car", 0.5, None)]
    masks = spark.createDataFrame(rows, "frame_id long, camera string, instance int, class_name string, confidence double, runs array<struct<r: long, first: long, end: long>>")
    got = {r.path: decode.picture(bytes(r.bytes))[:, :, 0] for r in painting.mask_pictures(masks, 6, 8).collect()}
    assert sorted(got) == [f"segmentation_masks/camera1/{7:019d}_00_car_0.50.png", f"segmentation_masks/camera1/{7:019d}_01_dog_0.25.png"]
    want = np.zeros((6, 8), int)
    want[1, 2:5], want[3, :2] = 255, 255
    first, second = (got[k] for k in sorted(got))
    assert np.array_equal(first, want) and not second.any()
