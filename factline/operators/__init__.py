"""factline.operators"""
