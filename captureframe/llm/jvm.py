"""Java forms of a module's inner loops, compiled at run time by Janino (the compiler of Spark's own code generation) and run in the executors."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import DataFrame, SparkSession

from captureframe.llm.files import put

#: Numpy's types as ContextMixing.java reads them.
KINDS = {"u1": b"b", "u2": b"H", "i4": b"i", "u4": b"i", "f4": b"f", "f8": b"d"}
_built: dict[tuple[str, str], Compiled] = {}


def put_arrays(uri: str, arrays: list[np.ndarray]) -> str:
    """Flat arrays in one file of the shared folder; returns ``uri``."""
    parts = [np.int32(len(arrays)).astype("<i4").tobytes()]
    for x in arrays:
        kind = x.dtype.str[1:]
        parts += [KINDS[kind], np.int64(x.size).astype("<i8").tobytes(), np.ascontiguousarray(x, dtype="<" + kind).tobytes()]
    put(uri, parts, 0)
    return uri


class Compiled:
    """A class of ``name``.java beside this file: MapPartitionsFunction of (work, uris)."""

    def __init__(self, spark: SparkSession, name: str):
        self.jvm, self.gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
        compiler = self.jvm.org.codehaus.janino.SimpleCompiler()
        compiler.setParentClassLoader(self.jvm.java.lang.Thread.currentThread().getContextClassLoader())
        compiler.cook(Path(__file__).with_name(f"{name}.java").read_text())
        codes = compiler.getBytecodes()
        jar = Path(tempfile.mkdtemp(prefix="captureframe-")).resolve() / f"{name}.jar"
        with zipfile.ZipFile(jar, "w") as z:
            for k in codes:
                z.writestr(k.replace(".", "/") + ".class", bytes(codes[k]))
        spark.sparkContext._jsc.addJar(str(jar))  # the driver serves it to the executors
        kind = compiler.getClassLoader().loadClass(f"captureframe.llm.{name}")
        self.maker = kind.getConstructors()[0]

    def rows(self, df: DataFrame, work: str, uris: list[str], schema: str) -> DataFrame:
        """What ``work`` makes of each partition of ``df``."""
        sent = self.gateway.new_array(self.jvm.java.lang.String, len(uris))
        for i, uri in enumerate(uris):
            sent[i] = uri
        given = self.gateway.new_array(self.jvm.java.lang.Object, 2)
        given[0], given[1] = work, sent
        out = self.jvm.org.apache.spark.sql.types.StructType.fromDDL(schema)
        return DataFrame(df._jdf.mapPartitions(self.maker.newInstance(given), self.jvm.org.apache.spark.sql.Encoders.row(out)), df.sparkSession)


def compiled(spark: SparkSession, name: str) -> Compiled | None:
    """The class, built once for each Spark application; None where there is no such compiler, and numpy does the same in more time."""
    key = (spark.sparkContext.applicationId, name)
    if key not in _built:
        try:
            _built[key] = Compiled(spark, name)
        except TypeError:  # Janino is not on the driver's class path: its name is a package to py4j, which can't be called
            _built[key] = None
    return _built[key]
