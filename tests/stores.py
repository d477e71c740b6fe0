"""The small stores of the fixtures, written from their logical contents.

Names, shapes and values are fixed values: they are those of the results to match.
"""

import numpy as np

from gridframe.sources import writer as w

GZIP = {"id": "gzip", "level": 1}
GZIP_V3 = {"name": "gzip", "configuration": {"level": 1}}


def simple_v2(path):
    groups = {"": w.v2_group(path), "stations": w.v2_group(path, "stations")}
    arrays = {
        "temperature": w.v2_array(path, "temperature", (4, 3), (2, 2), "<f8", compressor=GZIP),
        "mask": w.v2_array(path, "mask", (2, 3), (2, 2), "|b1", fill=False),
        "half_precision": w.v2_array(path, "half_precision", (2, 2), (2, 2), "<f2"),
        "sparse_fill": w.v2_array(path, "sparse_fill", (2, 3), (2, 2), "<i4", fill=-1),
        "stations/elevation": w.v2_array(path, "stations/elevation", (2,), (2,), "<i4", separator="/"),
    }
    w.write_values(path, "temperature", np.arange(12).reshape(4, 3) + 1.5)
    w.write_values(path, "mask", np.array([[1, 0, 0], [1, 1, 1]]))
    w.write_values(path, "half_precision", np.array([[1.5, -2.0], [0.5, 4.0]]))
    w.write_values(path, "sparse_fill", np.array([[1, 2, 0], [4, 5, 0]]), skip={(0, 1)})
    w.write_values(path, "stations/elevation", np.array([100, 200]))
    w.consolidate(path, groups, arrays)
    return path


def simple_v3(path):
    w.v3_group(path)
    w.v3_array(path, "temperature_v3", (3, 2), (2, 2), "float64", [w.BYTES, GZIP_V3])
    w.v3_array(path, "mask_v3", (2, 3), (2, 2), "bool", [{"name": "bytes"}], fill=False, encoding="v2", separator=".")
    w.v3_array(path, "fortran_v3", (2, 2), (2, 2), "int32", [{"name": "transpose", "configuration": {"order": [1, 0]}}, w.BYTES], fill=0)
    w.write_values(path, "temperature_v3", np.arange(6).reshape(3, 2) + 1.0)
    w.write_values(path, "mask_v3", np.array([[1, 0, 0], [1, 1, 1]]))
    w.write_values(path, "fortran_v3", np.array([[1, 2], [3, 4]]))
    return path


def image_v2(path):
    w.v2_group(path)
    w.v2_array(path, "0", (2, 2, 3), (1, 2, 2), "<u2", compressor=GZIP, fill=0)
    w.write_values(path, "0", np.arange(12).reshape(2, 2, 3) + 1)
    w.store_at(path).write(".zattrs", b'{"multiscales": []}')
    return path
