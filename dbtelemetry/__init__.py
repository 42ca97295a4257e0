"""dbtelemetry: database-server telemetry reports on Spark."""

from __future__ import annotations

import os
import tempfile
import zipfile

_SHIPPED: set = set()


def ship_to_executors(spark) -> None:
    """Make this package importable in Python workers (pandas UDF bodies), in local mode.

    On a cluster the package is deployed with the job (``--py-files``), so
    nothing is done there. In local mode (tests, the driver's checks) the
    package is zipped once and registered with ``addPyFile``.
    """
    sc = spark.sparkContext
    key = (id(sc), sc.applicationId)
    if key in _SHIPPED or not sc.master.startswith("local"):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    fd, path = tempfile.mkstemp(prefix="dbtelemetry-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for base, _dirs, files in os.walk(root):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(root)))
    sc.addPyFile(path)
    _SHIPPED.add(key)
