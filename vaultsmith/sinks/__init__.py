"""Writers: schemas, vault/stage table DDL, stage overwrite, delta append."""
