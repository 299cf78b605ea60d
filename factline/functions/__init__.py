"""factline.functions"""
