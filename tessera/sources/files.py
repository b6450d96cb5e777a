"""Files on whatever file system the cluster has, by the file system classes that Spark itself uses."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession


class Files:
    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def _at(self, path: str):
        place = self._jvm.org.apache.hadoop.fs.Path(str(path))
        return place.getFileSystem(self._conf), place

    def exists(self, path: str) -> bool:
        fs, place = self._at(path)
        return fs.exists(place)

    def delete(self, path: str) -> None:
        fs, place = self._at(path)
        fs.delete(place, True)

    def names(self, folder: str) -> list[str]:
        """Names of what lies in a folder; none if there is no such folder."""
        fs, place = self._at(folder)
        return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []

    def find(self, folder: str, suffix: str) -> list[str]:
        """Paths of all files below a folder that end so, hidden ones left out."""
        fs, place = self._at(folder)
        found, rest = [], fs.listFiles(place, True)
        while rest.hasNext():
            path = rest.next().getPath()
            if path.getName().endswith(suffix) and not path.getName().startswith((".", "_")):
                found.append(path.toString())
        return sorted(found)

    def modified_ms(self, path: str) -> int:
        fs, place = self._at(path)
        return fs.getFileStatus(place).getModificationTime()

    def read_text(self, path: str) -> str:
        fs, place = self._at(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def sha256(self, path: str) -> str:
        """The digest of a file's bytes, read in a stream."""
        fs, place = self._at(path)
        stream = fs.open(place)
        try:
            return self._jvm.org.apache.commons.codec.digest.DigestUtils.sha256Hex(stream)
        finally:
            stream.close()

    def _publish(self, beside: str, path: str) -> bool:
        """Give a complete file its name; False if the name is taken. One of two writers wins."""
        fs, new = self._at(beside)
        _, place = self._at(path)
        if fs.getScheme() == "file":  # a local rename would replace the file without a word
            plain = lambda p: p.toUri().getPath()
            try:
                os.link(plain(new), plain(place))
                done = True
            except FileExistsError:
                done = False
        else:
            done = not fs.exists(place) and fs.rename(new, place)
        fs.delete(new, False)
        return done

    def _beside(self, path: str) -> str:
        folder, _, _ = str(path).rpartition("/")
        return f"{folder}/.new-{uuid.uuid4().hex}"

    def write_new(self, path: str, text: str) -> bool:
        """Write a file that does not exist yet; False, and nothing is changed, if it does."""
        beside = self._beside(path)
        fs, place = self._at(beside)
        stream = fs.create(place, True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        return self._publish(beside, path)

    def copy_new(self, source: str, path: str) -> bool:
        """Copy a file to a name that does not exist yet; False if it does."""
        beside = self._beside(path)
        from_fs, from_place = self._at(source)
        to_fs, to_place = self._at(beside)
        self._jvm.org.apache.hadoop.fs.FileUtil.copy(from_fs, from_place, to_fs, to_place, False, True, self._conf)
        return self._publish(beside, path)

    def footer(self, path: str) -> tuple[list[tuple[str, str, bool]], set[str]]:
        """Of a Parquet file its columns (name, physical or logical type, optional) and codecs."""
        _, place = self._at(path)
        hadoop = self._jvm.org.apache.parquet.hadoop
        reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(place, self._conf))
        try:
            meta = reader.getFooter()
            columns = []
            for field in meta.getFileMetaData().getSchema().getFields():
                kind = "GROUP" if not field.isPrimitive() else field.getPrimitiveTypeName().toString()
                logical = field.getLogicalTypeAnnotation()
                columns.append((field.getName(), f"{kind} {logical.toString()}" if logical else kind, field.getRepetition().toString() == "OPTIONAL"))
            codecs = {chunk.getCodec().toString() for block in meta.getBlocks() for chunk in block.getColumns()}
            return columns, codecs
        finally:
            reader.close()
