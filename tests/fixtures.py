"""A synthetic COCO dataset of PNG images, with the odd cases that real folders have."""

import json

import numpy as np

from shardloom.functions import pixels


def picture(i: int, seed: int = 0) -> np.ndarray:
    """Sharp random blocks with a gradient; no two indexes are near each other."""
    w, h = 96 + i % 5 * 24, 80 + i % 4 * 20
    rng = np.random.default_rng(1000 * seed + i)
    blocks = rng.integers(0, 256, (h // 8 + 1, w // 8 + 1, 3))
    return np.kron(blocks, np.ones((8, 8, 1)))[:h, :w].astype(np.uint8)


def coco_dataset(root, n: int = 10, labels: bool = True) -> None:
    """raw/images/img_000.png ... and raw/annotations/instances.json: one box an image, the second also a crowd."""
    images, folder = root / "raw" / "images", root / "raw" / "annotations"
    images.mkdir(parents=True)
    folder.mkdir(parents=True)
    doc = {"images": [], "annotations": [], "categories": [{"id": 7, "name": "thing"}, {"id": 3, "name": "object"}]}
    for i in range(n):
        a = picture(i)
        h, w = a.shape[:2]
        (images / f"img_{i:03d}.png").write_bytes(pixels.png(a))
        doc["images"].append({"id": i + 1, "file_name": f"img_{i:03d}.png", "width": w, "height": h})
        doc["annotations"].append({"id": i + 1, "image_id": i + 1, "category_id": 3 if i % 2 else 7, "bbox": [8 + i % 3 * 4, 10 + i % 2 * 6, max(20, w // 3), max(18, h // 3)], "iscrowd": 0})
    doc["annotations"].append({"id": 999, "image_id": 2, "category_id": 3, "bbox": [0, 0, 5, 5], "iscrowd": 1})
    doc["annotations"].append({"id": 1000, "image_id": 4242, "category_id": 3, "bbox": [0, 0, 5, 5], "iscrowd": 0})
    if labels:
        (folder / "instances.json").write_text(json.dumps(doc))
