"""Files that only one of several writers can make."""

import os
import uuid

from pyspark.sql import SparkSession

from feedmill.sources.files import hadoop_place, local_path


def claim(spark: SparkSession, path: str, content: str) -> bool:
    """Make the file `path` with `content`, whole or not at all; False if it is there already.

    The content goes to a file of another name first. That file is then linked
    (on a local file system) or renamed (elsewhere), which of several writers
    only one can do. A store needs a rename that fails where the target exists.
    """
    folder, name = path.rsplit("/", 1)
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    local = local_path(spark, path)
    if local:
        # Python and the driver's JVM are on one machine.
        source = local_path(spark, draft)
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(source, "w", encoding="utf-8") as file:
            file.write(content)
        try:
            os.link(source, local)
            return True
        except FileExistsError:
            return False
        finally:
            os.unlink(source)
    fs, target = hadoop_place(spark, path)
    first = hadoop_place(spark, draft)[1]
    out = fs.create(first, False)
    out.write(bytearray(content, "utf-8"))
    out.close()
    if not fs.exists(target) and fs.rename(first, target):
        return True
    fs.delete(first, False)
    return False
