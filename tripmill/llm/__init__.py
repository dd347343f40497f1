"""Operations of a training-data pipeline over text and embedding tables."""
