"""Part of segloom."""
