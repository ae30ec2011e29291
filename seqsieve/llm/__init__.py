"""Operations of a training-data pipeline: token counts, media columns, decontamination, token files, piece
encoding, Jaccard joins, line removal, license scans, language-model scores and quality scores.

Nothing else in the library imports this subpackage."""
