"""Operations on the texts and vectors of training data."""
