from carelake.sources.files import (blob_uri, list_files, set_blob_sas, read_notes, scan_csv, scan_notes,
                                    scan_parquet, write_csv, write_notes)

__all__ = ["blob_uri", "set_blob_sas", "list_files", "read_notes", "scan_csv", "scan_notes", "scan_parquet",
           "write_csv", "write_notes"]
