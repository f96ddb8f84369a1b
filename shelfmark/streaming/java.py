"""Java classes of this package for a session: compiled where it starts, sent to the executors as a jar.

A stateful processor in Python asks the state store over a socket, several times for each key and micro-batch; one in Java calls it.
"""

from __future__ import annotations

import os
import tempfile
import zipfile
from functools import lru_cache

from pyspark.sql import SparkSession


def new_instance(spark: SparkSession, name: str):
    """An instance of the class whose source is ``name``.java in this folder."""
    return _loader(spark.sparkContext, name).loadClass(f"{__package__}.{name}").getDeclaredConstructor(
        spark.sparkContext._gateway.new_array(spark._jvm.java.lang.Class, 0)).newInstance(spark.sparkContext._gateway.new_array(spark._jvm.Object, 0))


@lru_cache(maxsize=None)
def _loader(context, name: str):
    """The driver's class loader for it, after the executors were told of the jar; once for a Spark context."""
    compiler = context._jvm.org.codehaus.janino.SimpleCompiler()  # the compiler that Spark has for its own generated code
    with open(os.path.join(os.path.dirname(__file__), f"{name}.java")) as f:
        compiler.cook(f.read())
    jar = os.path.join(tempfile.mkdtemp(prefix="shelfmark-"), f"{name}.jar")
    with zipfile.ZipFile(jar, "w") as z:
        for cls, code in compiler.getBytecodes().items():
            z.writestr(f"{cls.replace('.', '/')}.class", bytes(code))
    context._jsc.addJar(jar)
    return compiler.getClassLoader()
