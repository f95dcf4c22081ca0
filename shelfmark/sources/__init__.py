"""Reading and writing: catalogue files, tables, schemas, the shared folder."""
