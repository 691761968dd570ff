"""Operations of a training-data pipeline on Spark frames."""
