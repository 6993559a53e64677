"""File inventories."""


def file_inventory(spark, directory, extension=None, recursive=False):
    """Path, length and time of the files in a directory.

    ``extension`` is one extension or a list of them. Contents are never read:
    only the listing columns are selected.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    if extension is not None:
        wanted = [extension] if isinstance(extension, str) else list(extension)
        reader = reader.option("pathGlobFilter", "*.{" + ",".join(wanted) + "}")
    return reader.load(directory).select("path", "length", "modificationTime")
